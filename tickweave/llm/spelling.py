"""Spelling variants: words of one edit, grouped by finite-state composition.

The vocabulary's acceptor is composed with a transducer that makes exactly one edit (a code point
inserted, deleted or replaced) and with the acceptor again; every accepted pair is a pair of near
words. The composition is enumerated in partitions by its initial state. A pair's edit lies behind
the first half of the shorter word or within it: in the first case both words have read that half
without an edit, and the state reached there begins a partition; in the second case the same holds
for the second half, read from the end. A partition holds the words of two neighbouring lengths,
whose remainders are one minimal acyclic acceptor with an initial state for each length, and yields
sums a word, never pairs. A partition of more than GROUP_WORDS words is cut by its next letter: pairs
that agree in it go on together, and pairs that have their edit there agree in all that follows.

Defined cases: a null text has no words, a null id is the empty text before the colon; repeated
rows count each; an empty table, or one without words of enough occurrences, has no rows. Among
equally frequent near words the smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import arrow_schema, keyed_texts, materialize

MIN_LETTERS = 5
MIN_COUNT = 3
DIVISOR = 97            # a run whose checksum it divides loses a code point
GROUP_WORDS = 20_000    # words of one partition; larger ones are cut by their next letter
HELD_WORDS = 300_000    # words a task counts before it hands them on
PART_CHARS = 1 << 20    # a long text is counted in parts that end between words
LETTERS = "a-zÀ-ÿ"
RUN = re.compile(f"[{LETTERS}]{{{MIN_LETTERS},}}")
BREAK = re.compile(f"[^{LETTERS}]")
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# ---------------------------------------------------------------------------------- vocabulary
def text_parts(text: str, size: int = PART_CHARS):
    """A text cut at bytes that belong to no word."""
    low = 0
    while len(text) - low > size:
        found = BREAK.search(text, low + size)
        if not found:
            break
        yield text[low:found.start()]
        low = found.start()
    yield text[low:] if low else text


def noisy_word(run: str, start: int) -> str:
    """The run, or what is left of it if its checksum (continued from ``start``) says so."""
    check = zlib.crc32(run.encode(), start)
    if check % DIVISOR:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_count: int = MIN_COUNT, held_words: int = HELD_WORDS) -> DataFrame:
    """``word, n``: words of MIN_LETTERS code points or more with at least ``min_count`` occurrences."""
    schema = arrow_schema("word string, n long")

    def count(stream):
        held: Counter = Counter()
        for piece in B.text_slices(stream):
            ids = piece.rows.column(0).to_pylist()
            for row, ident in enumerate(ids):
                start = zlib.crc32(f"{'' if ident is None else ident}:".encode())
                text = piece.bytes_of(row).translate(LOWER).decode()
                for part in text_parts(text):
                    for run, times in Counter(RUN.findall(part)).items():
                        word = noisy_word(run, start)
                        if len(word) >= MIN_LETTERS:
                            held[word] += times
                    if len(held) > held_words:
                        yield B.batch_of(schema, list(held), list(held.values()))
                        held.clear()
        if held:
            yield B.batch_of(schema, list(held), list(held.values()))

    counted = keyed_texts(docs, id_col, text_col).select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------------------------- partitions
def partitions(words: DataFrame) -> DataFrame:
    """Every word with each initial state it belongs to (``g``) and what is left to read there.

    ``m`` is the length of the shorter word of a pair, so a word of length L is in partitions of
    m = L (as one of the shorter words) and m = L - 1 (``longer``), read forth and back.
    """
    size = F.char_length("word")
    sides = words.filter(size >= MIN_LETTERS).select(
        "word", "n", size.alias("l"), F.explode(F.array(F.lit(False), F.lit(True))).alias("longer")).withColumn(
        "m", F.col("l") - F.col("longer").cast("int")).filter(F.col("m") >= MIN_LETTERS).withColumn(
        "k", F.expr("m div 2").cast("int")).withColumn(
        "back", F.explode(F.array(F.lit(False), F.lit(True))))
    cut = F.when(F.col("back"), F.col("l") - (F.col("m") - F.col("k"))).otherwise(F.col("k"))
    head, tail = F.expr("left(word, cut)"), F.expr("substring(word, cut + 1)")
    return sides.withColumn("cut", cut).select(
        F.concat(F.when(F.col("back"), "b").otherwise("f"), F.col("m").cast("string"), F.lit(":"),
                 F.when(F.col("back"), tail).otherwise(head)).alias("g"),
        "back", "longer", F.when(F.col("back"), F.reverse(head)).otherwise(tail).alias("rest"), "word", "n")


def cut_large(parted: DataFrame, group_words: int) -> DataFrame:
    """Cut partitions of more than ``group_words`` words until there are none.

    A round cuts by the next letters, twice as many each round. Each word of such a partition goes
    on to the partition of these letters, where pairs with a later edit meet. Pairs with their edit
    at one of the letters have the same text before and behind it, which names partitions of at most
    one word a letter; these are never cut. A letter that repeats the next one counts as inserted
    further on.
    """
    done, step = None, 1
    while True:
        sizes = parted.groupBy("g").agg(F.count(F.lit(1)).alias("words"))
        large = materialize(sizes.filter(F.col("words") > group_words).select("g"))
        if large.isEmpty():
            return parted if done is None else done.unionByName(parted)
        small = materialize(parted.join(large, "g", "left_anti").select(*parted.columns))
        done = small if done is None else done.unionByName(small)
        moved = materialize(parted.join(large, "g").withColumn("l", F.char_length("rest")))
        # an edit of a longer word takes a letter away, one of a shorter word may also stand at its end
        places = moved.withColumn("p", F.explode(F.expr(
            f"sequence(0, greatest(least({step}, l + IF(longer, 0, 1)) - 1, 0))")))
        letter, before = F.expr("substring(rest, p + 1, 1)"), F.expr("left(rest, p)")
        behind = F.expr("substring(rest, p + 2)")

        def named(kind, *text):
            return F.concat("g", F.lit(kind), F.md5(F.concat_ws("/", *text)))

        at = F.col("p") < F.col("l")
        edits = places.select(F.explode(F.array(
            F.when(at & ~F.col("longer"), F.struct(named("=s", before, behind).alias("g"), letter.alias("rest"))),
            F.when(~F.col("longer"), F.struct(
                named("=i", before, F.expr("substring(rest, p + 1)")).alias("g"), F.lit("").alias("rest"))),
            F.when(at & F.col("longer") & (letter != F.expr("substring(rest, p + 2, 1)")), F.struct(
                named("=i", before, behind).alias("g"), letter.alias("rest"))))).alias("way"),
            "back", "longer", "word", "n").filter("way is not null")
        edits = edits.select("way.g", "back", "longer", "way.rest", "word", "n")
        done = done.unionByName(materialize(edits))
        parted = materialize(moved.filter(F.col("l") >= step).select(
            F.concat("g", F.lit("+"), F.expr(f"left(rest, {step})")).alias("g"), "back", "longer",
            F.expr(f"substring(rest, {step + 1})").alias("rest"), "word", "n"))
        step *= 2


# ---------------------------------------------------------------------------------- automata
class Acceptor:
    """Minimal acyclic acceptors of sorted word lists over one register of states.

    A state is the row ``(final, ((letter, target, strings before it), ...))``. Words are numbered in
    order by adding up the strings before each arc taken. A target has a smaller number than the
    states that lead to it.
    """

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.final: list[bool] = []
        self.arcs: list[tuple] = []
        self.sizes: list[int] = []

    def state(self, final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        found = self.register.get(key)
        if found is None:
            found = self.register[key] = len(self.final)
            total, numbered = int(final), []
            for letter, target in arcs:
                numbered.append((letter, target, total))
                total += self.sizes[target]
            self.final.append(final)
            self.arcs.append(tuple(numbered))
            self.sizes.append(total)
        return found

    def add(self, words: list[str]) -> int:
        """The initial state for sorted distinct words."""
        open_states = [[False, []]]     # states of the last word's path, not yet registered
        last = ""
        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            self.close(open_states, last, shared)
            open_states += [[False, []] for _ in range(len(word) - shared)]
            open_states[-1][0] = True
            last = word
        self.close(open_states, last, 0)
        return self.state(*open_states[0])

    def close(self, open_states: list, word: str, keep: int) -> None:
        while len(open_states) > keep + 1:
            target = self.state(*open_states.pop())
            open_states[-1][1].append((word[len(open_states) - 1], target))

    def replaced(self, initial: int) -> list[tuple[int, int]]:
        """Numbers of all pairs of words of the initial state that differ in one letter.

        Pairs below a state are found once, whatever number of paths lead to it.
        """
        pairs: list[list] = []
        for state in range(initial + 1):
            found = []
            for _, target, before in self.arcs[state]:
                if pairs[target]:
                    found += [(a + before, b + before) for a, b in pairs[target]]
            if len(self.arcs[state]) > 1:
                found += self.agreeing([(t, before) for _, t, before in self.arcs[state]])
            pairs.append(found)
        return pairs[initial]

    def agreeing(self, members: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Pairs of numbers of equal strings that are read on from different members."""
        found, stack = [], [members]
        while stack:
            members = stack.pop()
            ends = [number for state, number in members if self.final[state]]
            found += [(a, b) for i, a in enumerate(ends) for b in ends[i + 1:]]
            stack += self.steps(members)
        return found

    def steps(self, members):
        """Members by the letter they read next, where two or more can."""
        ways: dict[str, list] = {}
        for state, number in members:
            for letter, target, before in self.arcs[state]:
                ways.setdefault(letter, []).append((target, number + before))
        return [way for way in ways.values() if len(way) > 1]

    def inserted(self, longer: int, shorter: int) -> list[tuple[int, int]]:
        """Numbers (of the longer, of the shorter) of all pairs where one letter is inserted.

        The letter counts as inserted at its last place, so it differs from the letter behind it.
        """
        found, stack = [], [(longer, shorter, 0, 0)]
        while stack:
            state, other, number, base = stack.pop()
            here = {letter: (target, before) for letter, target, before in self.arcs[other]}
            for letter, target, before in self.arcs[state]:
                found += self.shared(target, other, number + before, base, letter)
                if letter in here:
                    stack.append((target, here[letter][0], number + before, base + here[letter][1]))
        return found

    def shared(self, state: int, other: int, number: int, base: int, but: str) -> list[tuple[int, int]]:
        """Pairs of numbers of equal strings read on from two states, not beginning with ``but``."""
        found, stack = [], [(state, other, number, base, but)]
        while stack:
            state, other, number, base, but = stack.pop()
            if self.final[state] and self.final[other]:
                found.append((number, base))
            arcs, others = self.arcs[state], self.arcs[other]
            if not arcs or not others:
                continue
            here = {letter: (target, before) for letter, target, before in others}
            for letter, target, before in arcs:
                if letter in here and letter != but:
                    stack.append((target, here[letter][0], number + before, base + here[letter][1], ""))
        return found


def near_in_group(back: bool, longer: list[tuple], shorter: list[tuple]) -> dict[str, list]:
    """Per word of one partition: number of near words, count of the best one and the best one.

    Both lists hold ``(rest, word, n)``. Read from the end, an inserted pair that agrees in the first
    half of the shorter word is left to the partitions read forth, which have it too.
    """
    longer.sort()
    shorter.sort()
    found: dict[str, list] = {}

    def note(word, other, n):
        entry = found.get(word)
        if entry is None:
            found[word] = [1, n, other]
            return
        entry[0] += 1
        if n > entry[1] or n == entry[1] and other < entry[2]:
            entry[1:] = n, other

    machine = Acceptor()
    initial = machine.add([rest for rest, _, _ in shorter])
    if len(shorter) > 1:
        for a, b in machine.replaced(initial):
            (_, word, n), (_, other, m) = shorter[a], shorter[b]
            note(word, other, m)
            note(other, word, n)
    if longer:
        start = machine.add([rest for rest, _, _ in longer])
        for a, b in machine.inserted(start, initial):
            (_, word, n), (_, other, m) = longer[a], shorter[b]
            half = len(other) // 2
            if back and word[:half] == other[:half]:
                continue
            note(word, other, m)
            note(other, word, n)
    return found


NEAR = "word string, near long, best_n long, best string"


def near_words(parted: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that has a near word."""
    schema = arrow_schema(NEAR)
    flat = parted.select(F.xxhash64("g").alias("g1"), F.xxhash64(F.lit(1), "g").alias("g2"), "back", "longer",
                         "rest", "word", "n")

    def run(stream):
        def flush(rows):
            return B.batch_of(schema, [w for w, _ in rows], [e[0] for _, e in rows],
                              [e[1] for _, e in rows], [e[2] for _, e in rows])

        key, back, lists, out = None, False, ([], []), []
        for batch in stream:
            for a, b, side, longer, rest, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                if (a, b) != key:
                    out += compose(back, *lists)
                    key, back, lists = (a, b), side, ([], [])
                lists[longer].append((rest, word, n))
            if out:
                yield flush(out)
                out = []
        out += compose(back, *lists)
        if out:
            yield flush(out)

    found = flat.repartition("g1", "g2").sortWithinPartitions("g1", "g2").mapInArrow(run, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))


def compose(back: bool, shorter: list, longer: list) -> list:
    if not shorter or len(shorter) + len(longer) < 2:
        return []
    return list(near_in_group(back, longer, shorter).items())


# ---------------------------------------------------------------------------------- forms and roots
def roots_of(formed: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: pointers jump twice as far each round.

    A form has at least twice the occurrences, so a way has at most 62 steps and seven rounds do.
    """
    pointers = materialize(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        onward = pointers.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        jumped = materialize(pointers.join(onward, "root", "left").select(
            "word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        if jumped.filter("moved").isEmpty():
            return jumped.select("word", "root")
        pointers = jumped.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_count: int = MIN_COUNT, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary."""
    words = materialize(vocabulary(docs, id_col, text_col, min_count))
    near = near_words(cut_large(partitions(words), group_words))
    formed = materialize(words.join(near, "word", "left").withColumn(
        "good", F.coalesce(F.col("best_n") >= 2 * F.col("n"), F.lit(False))).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("good"), F.col("best")).alias("form"),
        F.when(F.col("good"), F.col("best_n")).alias("form_n")))
    return formed.join(roots_of(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
