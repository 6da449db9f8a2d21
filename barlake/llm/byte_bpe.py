"""Byte-level BPE by ranks, with Spark's higher-order functions (operator 11).

The vocabulary is a file of base64 tokens and their ranks. Encoding takes three steps inside each
task, without a shuffle: texts are cut by the pattern, the distinct words of the task are
numbered, and the tokens that stand anywhere in a word are looked up; ``aggregate`` folds the ranked merges over
these candidates of every distinct word; the ids of the words are laid out in the order of the texts. Between the
steps a row is a chunk of texts with the words that are new in it, and the last step remembers the ids of the words
before; both sides forget them beyond ``WORDS`` words, and a row says how many words it builds upon. Decoding looks
up the bytes of each id in a literal array and joins them.

Merging can make a token from one pair of symbols only, as all merges inside it come in the order of the token
alone. So a merge is a candidate with three places, the start, the middle and the end, and it happens if these are the
borders of two neighbouring symbols when its turn comes. Turns are by rank, then from the left, because a
merge only makes pairs of a higher rank. (Words that hold a token ranked below one of its parts are merged with a heap.)
The state of the fold is a number, one bit for each two bytes that are joined; in words beyond ``SHORT_BYTES``
it is a list of borders. Afterwards the candidates between two neighbouring borders are the tokens of the word, and bytes outside
them are tokens of their own. Words beyond ``LONG_BYTES``, for which that list would take quadratic time, are
merged with a heap instead.

Nulls are encoded as the empty text, ids outside the vocabulary (and null ids) decode to nothing, and a
text of any length, repeated rows and empty tables need nothing special. Columns besides the text
pass through; an output column that exists already is replaced. Ids are ``array<int>``.
"""

from __future__ import annotations

import base64
import heapq
import json
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.bpe import PATTERN
from barlake.llm.text import chunks, column, list_array, utf8

# Characters of text in a chunk; bytes of text that are decoded and whose pieces are held at once; distinct words a
# task remembers.
CHUNK_CHARS = 1_000_000
SPLIT_CHARS = 500_000
WORDS = 400_000
# Rows in a batch of the result, and bytes of the longest word that is folded.
OUT_ROWS = 2_000
LONG_BYTES = 256

# A candidate of a short word: bits of its span | bits joined inside before it | its id; of a wide one, with the sign
# bit: its start | its middle | its end | its id.
ID_BITS, JOINED_AT, SPAN_AT, SHORT_BYTES = 20, 20, 42, 20
END_AT, MIDDLE_AT, START_AT, PLACE_BITS = 20, 29, 38, 9
ID = (1 << ID_BITS) - 1
JOINED = (1 << (SPAN_AT - JOINED_AT)) - 1
PLACE = (1 << PLACE_BITS) - 1
WIDE = -1 << 63
# Kinds of characters, and what may follow an apostrophe.
LETTER, NUMBER, SPACE = 1, 2, 3
ENDINGS = np.array([ord(c) for c in "stmd"]), np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a vocabulary file; a rank is the token's id."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    if max(ranks.values()) >= ID or not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks must be below {ID} and hold every byte")
    return ranks


# --- the fold -----------------------------------------------------------------------------


def _fold_short(word: Column) -> Column:
    """The state is a number whose bit p is 1 when the bytes on both sides of place p are joined."""

    def span(c: Column) -> Column:
        return F.shiftrightunsigned(c, SPAN_AT)

    def inside(c: Column) -> Column:  # the span without its two ends
        return F.shiftrightunsigned(c, SPAN_AT + 1).bitwiseAND(F.shiftrightunsigned(c, SPAN_AT - 1))

    def step(state: Column, c: Column) -> Column:
        before = F.shiftrightunsigned(c, JOINED_AT).bitwiseAND(F.lit(JOINED))
        return F.when(state.bitwiseAND(span(c)) == before, state.bitwiseOR(inside(c))).otherwise(state)

    def finish(state: Column) -> Column:
        return F.filter(word, lambda c: state.bitwiseAND(span(c)) == inside(c))

    return F.aggregate(word, F.lit(0).cast("long"), step, finish)


def _fold_wide(word: Column) -> Column:
    """The state is the list of the places where tokens meet."""

    def place(c: Column, at: int) -> Column:
        return F.shiftright(c, at).bitwiseAND(F.lit(PLACE))

    def step(state: Column, c: Column) -> Column:
        middle = place(c, MIDDLE_AT)
        at = F.array_position(state, middle).cast("int")
        whole = (F.get(state, at - 2) == place(c, START_AT)) & (F.get(state, at) == place(c, END_AT))
        return F.when(whole, F.array_remove(state, middle)).otherwise(state)

    def finish(state: Column) -> Column:
        def left(c: Column) -> Column:
            return F.get(state, F.array_position(state, place(c, START_AT)).cast("int")) == place(c, END_AT)

        return F.filter(word, left)

    start = F.sequence(F.lit(0).cast("long"), F.array_max(F.transform(word, lambda c: place(c, END_AT))))
    return F.aggregate(word, start, step, finish)


def fold_words(words: Column) -> Column:
    """The candidates of each word that are its tokens."""
    return F.transform(words, lambda w: F.when(F.get(w, F.lit(0)) < 0, _fold_wide(w)).otherwise(_fold_short(w)))


# --- words of a chunk, and texts from words ------------------------------------------------


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges over a linked list, with the pairs in a heap."""
    size = len(word)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    ends = list(range(1, size + 1))  # 0: the symbol has become a part of the one before it
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        following = after[at]
        if following < size:
            rank = ranks.get(word[at : ends[following]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, ends[following]))

    for at in range(size):
        offer(at)
    while heap:
        _, at, end = heapq.heappop(heap)
        following = after[at]
        if not ends[at] or following >= size or ends[following] != end:
            continue
        ends[at], ends[following], after[at] = end, 0, after[following]
        if after[at] < size:
            before[after[at]] = at
        offer(at)
        if before[at] >= 0:
            offer(before[at])
    return [ranks[word[at : ends[at]]] for at in range(size) if ends[at]]


def last_merge(token: bytes, ranks: dict[bytes, int]) -> int:
    """Where the two symbols meet that are merged to ``token`` at last, or 0 if merging does not lead there."""
    ends = list(range(len(token) + 1))
    while len(ends) > 3:
        pairs = [ranks.get(token[a:b], ID) for a, b in zip(ends, ends[2:], strict=False)]
        lowest = min(pairs)
        if lowest == ID:
            return 0
        del ends[pairs.index(lowest) + 1]
    return ends[1]


class Tokens:
    """What candidates are made of, by id, and a trie of the tokens that merging can lead to, as arrays: the child
    of node n by byte b is the base of n + b, if the parent of that is n."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        self.lengths, self.middles = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.early: list[bytes] = []
        self.symbols = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        children: dict[bytes, list[int]] = {b"": []}
        reached: dict[bytes, int] = {}
        for token, rank in ranks.items():
            middle = 0
            if len(token) > 1:
                middle = last_merge(token, ranks)
                if not middle:
                    continue
                parts = token[:middle], token[middle:]
                if any(len(p) > 1 and ranks[p] > rank for p in parts):
                    self.early.append(token)
            self.lengths[rank], self.middles[rank], reached[token] = len(token), middle, rank
            for end in range(len(token), 0, -1):
                known = token[: end - 1] in children
                children.setdefault(token[: end - 1], []).append(token[end - 1])
                if known:
                    break
        self._place({k: sorted(set(v)) for k, v in children.items()}, reached)
        # A candidate at place 0; one at place p has these bits p higher.
        short = np.where(self.lengths <= SHORT_BYTES, self.lengths, 0)
        spans = (2 << short) - 1
        joined = np.where(short > 1, (1 << short) - 2 - (1 << np.where(short > 1, self.middles, 0)), 0)
        self.masks = spans << SPAN_AT | joined << JOINED_AT

    def _place(self, children: dict[bytes, list[int]], reached: dict[bytes, int]) -> None:
        """Give every node a place in the arrays: in free ones from where the search stands, those with many siblings
        first; nodes without siblings fill the holes."""
        alone = sum(len(below) == 1 for below in children.values())
        free = np.ones(1024, bool)
        free[0] = False
        bases, lo, bands = {}, 0, np.arange(256)[:, None]
        for name, below in sorted(children.items(), key=lambda kv: -len(kv[1])):
            if len(below) == 1:
                break
            while True:
                if lo + 512 > len(free):
                    free = np.concatenate((free, np.ones(len(free), bool)))
                if (fit := free[lo + bands + below].all(axis=1)).any():
                    break
                lo += 256
            bases[name] = lo + int(fit.argmax())
            free[bases[name] + np.array(below)] = False
        free = np.concatenate((free, np.ones(256 + alone, bool)))
        holes = iter((np.flatnonzero(free[256:])[:alone] + 256).tolist())
        for name, below in children.items():
            if len(below) == 1:
                bases[name] = next(holes) - below[0]
                free[bases[name] + below[0]] = False
        top = int(np.flatnonzero(~free).max()) + 1
        nodes = {b"": 0} | {n + bytes([b]): base + b for n, base in bases.items() for b in children[n]}
        # Byte 256 is the edge of a word: no node has a child there, and leaves have none at all.
        self.bases, self.parents = np.full(top, top, np.int32), np.full(top + 257, -1, np.int32)
        self.ids = np.full(top, -1, np.int32)
        for name, node in nodes.items():
            if name in bases:
                self.bases[node] = bases[name]
            if name:
                self.parents[node] = nodes[name[:-1]]
            self.ids[node] = reached.get(name, -1)

    def find(self, raw: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and ids of all tokens of two bytes and more, by length; byte 256 stands behind every word."""
        starts, node, length = np.arange(len(raw), dtype=np.int32), np.zeros(len(raw), np.int32), 0
        while len(starts):
            below = self.bases[node] + raw[starts + length]
            found = np.flatnonzero(self.parents[below] == node)
            starts, node, length = starts[found], below[found], length + 1
            if length > 1:
                ids = self.ids[node]
                ends = np.flatnonzero(ids >= 0)
                yield starts[ends], ids[ends]


class Splitter:
    """Pieces of texts as the usual pattern cuts them, found in arrays of code points."""

    def __init__(self):
        codes = np.concatenate((np.arange(0xD800), np.arange(0xE000, sys.maxunicode + 1))).astype(np.uint32)
        every = codes.tobytes().decode("utf-32-le")
        self.kinds = np.zeros(sys.maxunicode + 1, np.uint8)
        for kind, members in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for run in regex.finditer(members, every):
                self.kinds[codes[run.start() : run.end()]] = kind

    def split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and how many each has."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        size = len(points)
        bounds = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        # Three more places, so that what stands behind the end needs no care.
        first = np.zeros(size + 3, bool)
        first[bounds] = first[size:] = True
        kinds = np.full(size + 3, SPACE + 1, np.uint8)
        kinds[:size] = self.kinds[points]
        begins = first.copy()
        begins[1:] |= kinds[1:] != kinds[:-1]
        # The last white space before something else: apart from those before it, and a blank goes with what follows.
        last = np.flatnonzero((kinds[:size] == SPACE) & begins[1 : size + 1] & ~first[1 : size + 1])
        begins[last] = True
        begins[last[points[last] == 0x20] + 1] = False
        # 's 't 'm 'd 're 've 'll, where a piece begins with them.
        quotes = np.flatnonzero((points == 0x27) & begins[:size])
        quotes = quotes[~first[quotes + 1]]
        following = points[quotes + 1]
        short = np.isin(following, ENDINGS[0])
        second = points[np.minimum(quotes + 2, size - 1)]
        pair = (following.astype(np.int64) << 32 | second)[:, None] == ENDINGS[1]
        long = pair.any(axis=1) & ~first[quotes + 2]
        begins[quotes[short | long] + 1] = False
        begins[quotes[short] + 2] = True
        begins[quotes[long] + 3] = True
        starts = np.flatnonzero(begins[:size])
        widths = np.ones(size, np.uint8)
        for more in (0x80, 0x800, 0x10000):
            widths += points >= more
        del points, kinds, first, begins
        offsets = np.zeros(len(starts) + 1, np.int32)
        offsets[1:] = np.cumsum(widths, dtype=np.int32)[np.append(starts[1:], size)[: len(starts)] - 1]
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(whole.encode()))
        return pieces, np.diff(np.searchsorted(starts, bounds))


class Numbering:
    """Numbers the distinct words of consecutive texts, and writes every text as numbers of words."""

    def __init__(self, ranks: dict[bytes, int], split: regex.Pattern, tokens: Tokens | None = None):
        self.ranks, self.split, self.tokens = ranks, split, tokens or Tokens(ranks)
        self.splitter = _splitter() if split.pattern == PATTERN else None
        self.known: dict[str, int] = {}
        self.folded = self.merged = 0
        self._next()

    def _next(self) -> None:
        if len(self.known) >= WORDS:
            self.known, self.folded, self.merged = {}, 0, 0
        self.base = (self.folded, self.merged)
        self.words: list[bytes] = []
        self.whole: list[tuple[int, int]] = []
        self.long: list[list[int]] = []
        self.chars = 0
        self.parts: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []

    def _early(self, word: bytes) -> bool:
        return any(token in word for token in self.tokens.early)

    def _number(self, word: str) -> int:
        raw = word.encode()
        whole = self.ranks.get(raw)
        if whole is None and (len(raw) > LONG_BYTES or self.tokens.early and self._early(raw)):
            self.long.append(merge_long(raw, self.ranks))
            self.merged += 1
            number = -self.merged
        else:
            if whole is not None:
                self.whole.append((len(self.words), whole))
            self.words.append(raw if whole is None else b"\0")
            number = self.folded
            self.folded += 1
        self.known[word] = number
        return number

    def add(self, rows: pa.RecordBatch, texts: list[str]) -> None:
        if self.splitter is not None:
            pieces, counts = self.splitter.split(texts)
        else:
            found = [self.split.findall(text) for text in texts]
            pieces = pa.array([p for part in found for p in part], pa.string())
            counts = np.fromiter(map(len, found), np.int64, len(found))
        flat = pieces.dictionary_encode()
        distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self.known
        numbers = [n if (n := known.get(w)) is not None else self._number(w) for w in distinct]
        codes = np.fromiter(numbers, np.int32, len(numbers))[flat.indices.to_numpy()]
        self.parts.append((rows, codes, counts))
        self.chars += sum(map(len, texts))

    def _packed(self) -> pa.Array:
        """The tokens that stand in each new word, by rank and place, as the fold takes them."""
        count = len(self.words)
        lengths = np.fromiter(map(len, self.words), np.int64, count)
        starts = np.cumsum(lengths + 1) - lengths - 1
        total = int((lengths + 1).sum())
        number = np.repeat(np.arange(count), lengths + 1)
        place = np.arange(total) - starts[number]
        raw = np.full(total, 256, np.int32)
        raw[place < lengths[number]] = np.frombuffer(b"".join(self.words), np.uint8)
        # Word (35 bits) | rank (20 bits) | place (8 bits).
        words_and_places = number << (ID_BITS + 8) | place
        found = [words_and_places[at] | ids.astype(np.int64) << 8 for at, ids in self.tokens.find(raw)]
        keys = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))
        number, ids, place = keys >> (ID_BITS + 8), keys >> 8 & ID, keys & 255
        packed = self.tokens.masks[ids] << place | ids
        wide = np.flatnonzero(lengths[number] > SHORT_BYTES)
        if len(wide):
            ids, place = ids[wide], place[wide]
            middle, end = place + self.tokens.middles[ids], place + self.tokens.lengths[ids]
            packed[wide] = WIDE | place << START_AT | middle << MIDDLE_AT | end << END_AT | ids
        counts = np.bincount(number, minlength=count)
        if self.whole:
            # One token, which stands for the one byte that the word is here.
            places, whole = np.array(self.whole).T
            packed = np.insert(packed, (np.cumsum(counts) - counts)[places], 3 << SPAN_AT | whole)
            counts[places] = 1
        return list_array(packed, counts, pa.int64())

    def row(self) -> pa.RecordBatch:
        """The chunk as one row: its new words, those merged already, and its rows with their codes."""
        rows = pa.Table.from_batches([r for r, _, _ in self.parts]).combine_chunks()
        codes = np.concatenate([c for _, c, _ in self.parts])
        counts = np.concatenate([n for _, _, n in self.parts])
        fields = [rows.column(i).combine_chunks() for i in range(rows.num_columns)]
        names = [f"c{i}" for i in range(len(fields))]
        nested = pa.StructArray.from_arrays([*fields, list_array(codes, counts, pa.int32())], [*names, "codes"])
        merged = pa.array(self.long, pa.list_(pa.int32()))
        lengths = pa.array(np.fromiter(map(len, self.words), np.int32, len(self.words)))
        lists = [lengths, self._packed(), merged, nested]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in lists]
        base = [pa.array([n], pa.int32()) for n in self.base]
        raw = pa.array([b"".join(self.words)], pa.binary())
        self._next()
        names = ["folded", "long", "bytes", "lengths", "words", "merged", "rows"]
        return pa.RecordBatch.from_arrays([*base, raw, *lists], names)


class Ids:
    """The ids of numbered words, as rows bring them."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def add(self, base: int, words: pa.Array) -> None:
        if base == 0:
            self.clear()
        if base != len(self.ends):
            raise RuntimeError(f"a chunk builds upon {base} words, {len(self.ends)} are known")
        lengths = words.value_lengths().to_numpy(zero_copy_only=False)
        self.ends = np.concatenate((self.ends, np.cumsum(lengths) + len(self.ids)))
        self.ids = np.concatenate((self.ids, words.flatten().to_numpy(zero_copy_only=False)))


def ids_of_words(symbols: np.ndarray, raw: bytes, lengths: np.ndarray, words: pa.Array) -> pa.Array:
    """The ids of each word: of the candidates that are left of it, and of the bytes that no one covers."""
    first = np.cumsum(lengths) - lengths
    count = words.value_lengths().to_numpy(zero_copy_only=False)
    packed = words.flatten().to_numpy(zero_copy_only=False)
    span = packed >> SPAN_AT
    start = np.where(packed < 0, packed >> START_AT & PLACE, np.bitwise_count((span & -span) - 1))
    width = np.where(packed < 0, (packed >> END_AT & PLACE) - start, np.bitwise_count(span) - 1)
    start += np.repeat(first, count)
    ids = symbols[np.frombuffer(raw, np.uint8)]
    ids[start] = packed & ID
    # Tokens do not overlap: behind the first byte of each the rest of its bytes go.
    change = np.zeros(len(ids) + 1, np.int8)
    change[start + 1] += 1
    change[start + width] -= 1
    kept = np.cumsum(change[:-1], dtype=np.int8) == 0
    ends = np.concatenate(([0], np.cumsum(kept)))
    return list_array(ids[kept], ends[first + lengths] - ends[first], pa.int32())


@lru_cache(maxsize=1)
def _splitter() -> Splitter:
    return Splitter()


@lru_cache(maxsize=4)
def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def chunk_rows(batches: Iterator[pa.RecordBatch], chunk: Numbering) -> Iterator[pa.RecordBatch]:
    """The rows of ``chunk`` for batches whose last column is the text.

    Texts are decoded a piece of the batch at a time, and no rows wait for the next batch, which they would keep whole.
    """
    for batch in batches:
        *kept, text = range(batch.num_columns)
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for lo, hi in chunks(sizes, SPLIT_CHARS):
            part = batch.slice(lo, hi - lo)
            chunk.add(part.select(kept), [t.decode() for t in utf8(part.column(text))])
            if chunk.chars >= CHUNK_CHARS:
                yield chunk.row()
        if chunk.parts:
            yield chunk.row()
        batch = part = None  # or they would stay while the next batch is read


def _laid_out(codes: np.ndarray, counts: np.ndarray, words: Ids, merged: Ids) -> pa.Array:
    """The ids of each text from its codes."""
    ends = np.concatenate((words.ends, merged.ends + len(words.ids)))
    lengths = np.diff(ends, prepend=0)
    ids = np.concatenate((words.ids, merged.ids))
    places = np.where(codes >= 0, codes, len(words.ends) - 1 - codes)
    taken = lengths[places]
    upto = np.cumsum(taken)
    total = int(upto[-1]) if len(upto) else 0
    out = ids[np.repeat(ends[places] - upto, taken) + np.arange(total)]
    bounds = np.concatenate(([0], upto))[np.concatenate(([0], np.cumsum(counts)))]
    return list_array(out, np.diff(bounds), pa.int32())


def encode(
    df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "ids", keep_text: bool = True
) -> DataFrame:
    """Add the token ids of each text; matches of ``pattern`` are encoded separately."""
    ranks = read_ranks(ranks_path)
    with open(ranks_path, "rb") as file:
        vocabulary = df.sparkSession.sparkContext.broadcast((file.read(), Tokens(ranks)))
    dropped = {out_col} if keep_text else {out_col, text_col}
    kept = [f for f in df.schema.fields if f.name not in dropped]
    names = [f.name for f in kept]
    inner = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(kept)]
    rows = T.ArrayType(T.StructType([*inner, T.StructField("codes", T.ArrayType(T.IntegerType()))]))
    fields = {
        "folded": T.IntegerType(),
        "long": T.IntegerType(),
        "bytes": T.BinaryType(),
        "lengths": T.ArrayType(T.IntegerType()),
        "words": T.ArrayType(T.ArrayType(T.LongType())),
        "merged": T.ArrayType(T.ArrayType(T.IntegerType())),
        "rows": rows,
    }
    middle = T.StructType([T.StructField(n, kind) for n, kind in fields.items()])
    result = T.StructType([*kept, T.StructField(out_col, T.ArrayType(T.IntegerType()))])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, tokens = vocabulary.value
        yield from chunk_rows(batches, Numbering(_ranks(content), regex.compile(pattern), tokens))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, merged, symbols = Ids(), Ids(), vocabulary.value[1].symbols
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = batch["lengths"].slice(i, 1).flatten().to_numpy().astype(np.int64)
                new = ids_of_words(symbols, batch["bytes"][i].as_py(), lengths, batch["words"].slice(i, 1).flatten())
                words.add(batch["folded"][i].as_py(), new)
                merged.add(batch["long"][i].as_py(), batch["merged"].slice(i, 1).flatten())
                rows = batch["rows"].slice(i, 1).flatten()
                for lo in range(0, len(rows), OUT_ROWS):
                    *fields, codes = rows.slice(lo, OUT_ROWS).flatten()
                    counts = codes.value_lengths().to_numpy(zero_copy_only=False)
                    ids = _laid_out(codes.flatten().to_numpy(zero_copy_only=False), counts, words, merged)
                    yield pa.RecordBatch.from_arrays([*fields, ids], [*names, out_col])
            batch = rows = fields = codes = ids = None

    given = df.select(
        *(column(n).alias(f"c{i}") for i, n in enumerate(names)), column(text_col).cast("string").alias("text")
    )
    numbered = given.mapInArrow(number, middle)
    folded = numbered.withColumn("words", fold_words(F.col("words")))
    return folded.mapInArrow(lay_out, result)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the bytes of each row's ids, as ``binary``; null for null ids.

    A piece is a string of one character per byte, so that ``array_join`` can join them.
    """
    ranks = read_ranks(ranks_path)
    pieces: list[str | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    bound = F.transform(
        F.array(table), lambda t: F.array_join(F.transform(column(ids_col), lambda i: F.get(t, i)), "")
    )
    return df.withColumn(out_col, F.encode(F.get(bound, F.lit(0)), "ISO-8859-1"))
