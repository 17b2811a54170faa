"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search keeps, for every position of the text, the best way to end there: the last piece and a
back-pointer. Only a window of the longest piece is alive at any time; whenever all back-pointer
paths that are still alive pass through one boundary, the ids before it are committed.

* A unigram model scores a path by the sum of its pieces' scores.
* A BPE model has exactly one valid path to every position: pieces may follow each other only if
  merging their characters anew gives the same two pieces. That makes the path of a position unique
  and equal to what applying the merges in order gives.

In both, a boundary is certain where no piece of the vocabulary can span it (before a space mark
that follows another character, around characters no piece holds). Texts are cut there first,
so equal stretches, mostly words, are encoded once and looked up afterwards.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import batches as B
from tickweave.llm.frames import quoted, ship_code

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
KEPT_STRETCHES = 500_000   # stretches a worker remembers
SHORT = 64                 # bytes


def proto_fields(data: bytes):
    """Field number and value of each field of a protobuf message."""
    def varint(at):
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at
    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at:at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at:at + size], at + size
        yield key >> 3, value


@dataclass
class Model:
    """Pieces of a model file; only identity normalisation is supported."""

    pieces: list[bytes]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    prefix: bool                     # a space mark is put before each text
    ids: dict[bytes, int] = field(default_factory=dict)
    byte_ids: dict[int, int] = field(default_factory=dict)
    unknown: int = 0
    longest: int = 1
    id_pairs: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self):
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind in (NORMAL, USER):
                self.ids.setdefault(piece, i)
            elif kind == BYTE:
                self.byte_ids[int(piece[1:-1], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
        self.longest = max(map(len, self.ids), default=1)
        normal = [self.scores[i] for i in self.ids.values()]
        self.penalty = min(normal, default=0.0) - 10.0
        self.used = {c for piece in self.ids for c in piece.decode()}
        #: ASCII characters that no piece holds stand alone
        self.alone = np.array([b < 0x80 and chr(b) not in self.used for b in range(256)])
        self.alone[0x20] = False
        self.endings: dict = {}
        for piece, i in self.ids.items():
            node = self.endings
            for char in reversed(piece.decode()):
                node = node.setdefault(char, {})
            node[0] = i
        self.mark_inside = any(SPACE in p.lstrip(SPACE) for p in self.ids)

    @classmethod
    def load(cls, path: str) -> "Model":
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, data: bytes) -> "Model":
        pieces, scores, kinds, bpe, prefix = [], [], [], False, True
        for number, value in proto_fields(data):
            if number == 1:
                own = dict(proto_fields(value))
                pieces.append(own.get(1, b""))
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                bpe = dict(proto_fields(value)).get(3, 1) == BPE
            elif number == 3:
                spec = dict(proto_fields(value))
                prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("only models without normalisation of the text are supported")
        return cls(pieces, scores, kinds, bpe, prefix)

    # -- encoding ------------------------------------------------------------------------------
    def fallback(self, char: bytes) -> list[int]:
        """Ids of a character without a piece."""
        if len(self.byte_ids) == 256:
            return [self.byte_ids[b] for b in char]
        return [self.unknown]

    def merged(self, raw: bytes) -> list[bytes]:
        """The symbols left after merging characters, best score first, leftmost on ties."""
        symbols = [c.encode() for c in raw.decode()]
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                piece = self.ids.get(symbols[i] + symbols[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at < 0:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether merging the characters of two neighbours anew gives the same two."""
        return self.merged(left + right) == [left, right]

    def short_path(self, text: str) -> list[int]:
        """The BPE path of a stretch that is shorter than the window, so nothing is committed early.

        Pieces that end at a position are found by walking a trie of reversed pieces backwards.
        """
        root, pairs = self.endings, self.id_pairs
        size = len(text)
        origin, piece_at = [0] * (size + 1), [-1] * (size + 1)
        for end in range(1, size + 1):
            node, start = root, end
            while start:
                start -= 1
                node = node.get(text[start])
                if node is None:
                    origin[end] = end - 1          # a character without a piece
                    break
                piece = node.get(0)
                if piece is None:
                    continue
                before = piece_at[start]
                if before >= 0:
                    key = before << 20 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) > KEPT_STRETCHES:
                            pairs.clear()
                        fits = pairs[key] = self.follows(
                            text[origin[start]:start].encode(), text[start:end].encode())
                    if not fits:
                        continue
                origin[end], piece_at[end] = start, piece
                break
            else:
                origin[end] = end - 1
        parts, end = [], size
        while end:
            if piece_at[end] >= 0:
                parts.append(piece_at[end])
            else:
                parts += reversed(self.fallback(text[end - 1:end].encode()))
            end = origin[end]
        parts.reverse()
        return parts

    def search(self, raw: bytes) -> list[int]:
        """Ids of a stretch of text whose spaces are space marks."""
        if self.bpe and len(raw) <= SHORT:
            return self.short_path(raw.decode())
        return self.stream(raw)

    def stream(self, raw: bytes) -> list[int]:
        """The search over a window that moves along, for stretches of any length."""
        ids, longest, n = self.ids, self.longest, len(raw)
        score, last = {0: 0.0}, {}         # alive positions: best score, start of the last piece
        out, done, at = [], 0, 0
        while at < n:
            step = 1
            lead = raw[at]
            if lead >= 0xC0:
                step = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            end = at + step                # positions are character ends
            best, origin = None, at
            for start in range(max(done, end - longest), end):
                if start not in score:
                    continue
                piece = ids.get(raw[start:end])
                if piece is None:
                    if start != at:
                        continue
                    value = self.penalty   # a character without a piece
                else:
                    value = self.scores[piece]
                if self.bpe:
                    before = last.get(start)
                    if before is None or self.follows(raw[before:start], raw[start:end]):
                        best, origin = 0.0, start
                        break              # the only valid way to end here
                elif best is None or score[start] + value > best:
                    best, origin = score[start] + value, start
            score[end], last[end] = best or 0.0, origin
            at = end
            if at - done > 4 * longest:    # commit what every alive path shares
                alive = {p for p in score if p > at - longest}
                while len(alive) > 1:
                    top = max(alive)
                    alive.remove(top)
                    alive.add(last.get(top, done))
                border = alive.pop()
                if border > done:
                    out += self.path(raw, last, done, border)
                    score = {p: s for p, s in score.items() if p >= border}
                    # the piece that ends at the border is still needed to test what follows it
                    last = {p: s for p, s in last.items() if p >= border}
                    done = border
        return out + self.path(raw, last, done, n)

    def path(self, raw: bytes, last: dict[int, int], low: int, high: int) -> list[int]:
        parts = []
        while high > low:
            start = last[high]
            piece = self.ids.get(raw[start:high])
            parts.append([piece] if piece is not None else self.fallback(raw[start:high]))
            high = start
        return [i for part in reversed(parts) for i in part]

    def encode(self, text: str) -> list[int]:
        """Ids of one text, in one search over the whole of it."""
        if not text:
            return []
        return self.search(self.marked(text))

    def marked(self, text: str) -> bytes:
        return ((" " if self.prefix else "") + text).encode().replace(b" ", SPACE)

    # -- decoding ------------------------------------------------------------------------------
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that each id stands for, one after another, and their borders."""
        words = [b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
                 else bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(SPACE, b" ")
                 for p, k in zip(self.pieces, self.kinds)]
        borders = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        return np.frombuffer(b"".join(words), np.uint8), borders


class Stretches:
    """Stretches and their ids in flat arrays, ordered by a 64-bit code of the stretch."""

    def __init__(self):
        self.codes, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.text, self.text_ends = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __len__(self):
        return len(self.codes)

    def find(self, codes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """The entry of each stretch ``data[start:end]``, -1 if there is none with the same bytes."""
        found = np.full(len(codes), -1)
        if not len(self):
            return found
        at = np.minimum(np.searchsorted(self.codes, codes), len(self) - 1)
        entry, sizes = self.entry[at], end - start
        same = np.flatnonzero((self.codes[at] == codes)
                              & (self.text_ends[entry + 1] - self.text_ends[entry] == sizes))
        if len(same):
            sizes, entry = sizes[same], entry[same]
            differs = self.text[B.ragged(self.text_ends[entry], sizes)] != data[
                B.ragged(start[same], sizes)]
            equal = ~np.logical_or.reduceat(differs, np.cumsum(sizes) - sizes)
            found[same[equal]] = entry[equal]
        return found

    def ids_of(self, entry: np.ndarray):
        """Ids of some entries, one after another, and their numbers."""
        counts = self.id_ends[entry + 1] - self.id_ends[entry]
        return self.ids[B.ragged(self.id_ends[entry], counts)], counts

    def add(self, codes, text, text_sizes, ids, id_counts) -> None:
        """Entries whose codes ascend; a code that is there already is found by its former entry."""
        number = len(self.text_ends) - 1 + np.arange(len(codes))
        at = np.searchsorted(self.codes, codes, "right")
        self.codes, self.entry = np.insert(self.codes, at, codes), np.insert(self.entry, at, number)
        self.text, self.ids = np.concatenate([self.text, text]), np.concatenate([self.ids, ids])
        self.text_ends = np.append(self.text_ends, self.text_ends[-1] + np.cumsum(text_sizes))
        self.id_ends = np.append(self.id_ends, self.id_ends[-1] + np.cumsum(id_counts))


class Remembered:
    """Ids of the stretches used lately: two generations, the older one is dropped when full.

    A worker keeps it from task to task, so it is held in arrays: about 50 bytes a stretch.
    """

    def __init__(self, size: int = KEPT_STRETCHES):
        self.size, self.young, self.old = size // 2, Stretches(), Stretches()

    def encode(self, model: Model, codes, data: np.ndarray, raw: bytes, start, end):
        """Ids of the stretches ``data[start:end]``, one after another, and their numbers.

        ``codes`` ascend. What is not known yet is searched.
        """
        parts, counts = [], np.zeros(len(codes), np.int64)
        young = self.young.find(codes, data, start, end)
        old = np.full(len(codes), -1)
        rest = np.flatnonzero(young < 0)
        old[rest] = self.old.find(codes[rest], data, start[rest], end[rest])
        order = [np.flatnonzero(young >= 0), np.flatnonzero(old >= 0), rest[old[rest] < 0]]
        for known, entry, rows in ((self.young, young, order[0]), (self.old, old, order[1])):
            ids, counts[rows] = known.ids_of(entry[rows])
            parts.append(ids)
        searched = [model.search(raw[low:high].replace(b" ", SPACE))
                    for low, high in zip(start[order[2]].tolist(), end[order[2]].tolist())]
        counts[order[2]] = [len(s) for s in searched]
        parts.append(np.fromiter((i for s in searched for i in s), np.int32))
        # the parts follow one another; ids go back to the order of the codes
        rows = np.concatenate(order)
        begin = np.empty(len(codes), np.int64)
        begin[rows] = np.cumsum(counts[rows]) - counts[rows]
        ids = np.concatenate(parts)[B.ragged(begin, counts)]
        fresh = (young < 0) & (end - start <= SHORT)
        self.put(codes[fresh], data, start[fresh], end[fresh],
                 ids[np.repeat(fresh, counts)], counts[fresh])
        return ids, counts

    def put(self, codes, data, start, end, ids, counts) -> None:
        """Remember short stretches in portions that fit the generation."""
        id_ends, low = np.concatenate([[0], np.cumsum(counts)]), 0
        while low < len(codes):
            if len(self.young) >= self.size:
                self.old, self.young = self.young, Stretches()
            high = min(len(codes), low + max(1, self.size - len(self.young)))
            sizes = end[low:high] - start[low:high]
            self.young.add(codes[low:high], data[B.ragged(start[low:high], sizes)], sizes,
                           ids[id_ends[low]:id_ends[high]], counts[low:high])
            low = high


_loaded: dict[str, Model] = {}
_stretches: dict[str, Remembered] = {}


def model_of(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model.load(path)
    return _loaded[path]


def encode_slice(model: Model, known: Remembered, data: np.ndarray, offsets: np.ndarray):
    """Ids of all texts of a slice, and the borders of the texts.

    Returns also the marked texts: the bytes that decoding must give back.
    """
    filled = np.diff(offsets) > 0
    if model.prefix:
        data = np.insert(data, offsets[:-1][filled], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
    raw = data.tobytes()
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64), data, offsets
    space = data == 0x20
    fresh = np.zeros(len(data), bool)
    if not model.mark_inside:
        fresh[1:] = space[1:] & ~space[:-1]
    alone = model.alone[data]
    fresh |= alone
    fresh[1:] |= alone[:-1]
    fresh[offsets[:-1][filled]] = True
    start = np.flatnonzero(fresh)
    end = np.append(start[1:], len(data))
    codes = B.Rolling(B.BYTE_CODES[data]).ranges(start, end)
    codes, example, kind = np.unique(codes, return_index=True, return_inverse=True)
    flat, sizes = known.encode(model, codes, data, raw, start[example], end[example])
    begin = np.cumsum(sizes) - sizes
    counts = sizes[kind]
    out = flat[B.ragged(begin[kind], counts)]
    borders = np.concatenate([[0], np.cumsum(counts)])
    return out, borders[np.searchsorted(start, offsets)], data, offsets


def encode(docs: DataFrame, text_col: str = "text", model_path: str = MODEL) -> DataFrame:
    """Append ``ids`` (array of int) and ``round_trip`` (decoding gives the text back).

    A null text has null ids and round_trip, an empty one no ids. The space mark U+2581 in a text
    is a space to the model; such a text comes back with spaces. All other columns are kept, but a
    column named ``ids`` or ``round_trip`` is replaced.
    """
    ship_code(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("ids", "round_trip")]
    source = docs.select(*[quoted(c) for c in kept])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    where = kept.index(text_col)

    def run(stream):
        model = model_of(model_path)
        known = _stretches.setdefault(model_path, Remembered())
        words, word_borders = model.table()
        for batch in stream:
            names = [f"c{i}" for i in range(batch.num_columns)]
            names[where] = "text"
            renamed = pa.RecordBatch.from_arrays(batch.columns, names=names)
            for piece in B.text_slices(iter([renamed])):
                data, offsets = without_marks(piece)
                ids, borders, marked, places = encode_slice(model, known, data, offsets)
                same = decodes(ids, borders, words, word_borders, marked, places)
                missing = piece.rows.column(where).is_null()
                lists = pa.ListArray.from_arrays(
                    pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*piece.rows.columns, masked(lists, missing), masked(pa.array(same), missing)],
                    names=[*kept, "ids", "round_trip"])

    return source.mapInArrow(run, f"{ddl}, ids array<int>, round_trip boolean")


def without_marks(piece: B.Slice) -> tuple[np.ndarray, np.ndarray]:
    """The texts with space marks as spaces."""
    if SPACE not in piece.data.tobytes():
        return piece.data, piece.offsets
    texts = [piece.bytes_of(i).replace(SPACE, b" ") for i in range(piece.rows.num_rows)]
    return (np.frombuffer(b"".join(texts), np.uint8),
            np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def masked(values: pa.Array, missing: pa.Array) -> pa.Array:
    if not missing.true_count:
        return values
    import pyarrow.compute as pc
    keep = pa.array(np.where(np.asarray(missing.to_numpy(zero_copy_only=False)), None,
                             np.arange(len(values))), pa.int64())
    return pc.take(values, keep)


def decode_bytes(ids: np.ndarray, words: np.ndarray, word_borders: np.ndarray):
    """Bytes of a run of ids and the size of each id's share."""
    sizes = (word_borders[1:] - word_borders[:-1])[ids]
    return words[B.ragged(word_borders[:-1][ids], sizes)], sizes


def decodes(ids, borders, words, word_borders, marked, places) -> np.ndarray:
    """Whether the ids of each text stand for exactly its bytes."""
    back, sizes = decode_bytes(ids, words, word_borders)
    ends = np.concatenate([[0], np.cumsum(sizes)])[borders]
    if len(back) == len(marked) and np.array_equal(ends, places):
        wrong = np.concatenate([[0], np.cumsum(back != marked)])
        return wrong[places[1:]] == wrong[places[:-1]]
    return np.array([np.array_equal(back[ends[i]:ends[i + 1]], marked[places[i]:places[i + 1]])
                     for i in range(len(places) - 1)], bool)


def decode(encoded: DataFrame, ids_col: str = "ids", out: str = "decoded",
           model_path: str = MODEL) -> DataFrame:
    """Append the text that ``ids`` stand for (null ids give null; broken UTF-8 is replaced)."""
    ship_code(encoded.sparkSession)
    kept = [c for c in encoded.columns if c != out]
    source = encoded.select(*[quoted(c) for c in kept])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    where = kept.index(ids_col)

    def run(stream):
        model = model_of(model_path)
        words, word_borders = model.table()
        for batch in stream:
            texts = []
            for ids in batch.column(where):
                if not ids.is_valid:
                    texts.append(None)
                    continue
                back, _ = decode_bytes(np.asarray(ids.values, np.int64), words, word_borders)
                text = back.tobytes().decode("utf-8", "replace")
                texts.append(text[1:] if model.prefix and text[:1] == " " else text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*kept, out])

    return source.mapInArrow(run, f"{ddl}, `{out}` string")


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     model_path: str = MODEL) -> DataFrame:
    """``doc_id``, ``n_ids``, ``ids`` and ``round_trip`` of every row."""
    own = docs.select(quoted(id_col).cast("long").alias("doc_id"),
                      quoted(text_col).cast("string").alias("text"))
    return encode(own, "text", model_path).select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids",
        "round_trip")
