"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised by the model's own rules and cut into units that no merge can cross:
no piece of the vocabulary holds the two characters at the cut side by side. Each unit is
merged through an agenda of all adjacent pairs of symbols that form a piece, best score first,
then leftmost: the best pair becomes one symbol, which makes new pairs with its neighbours.
Long units keep the agenda in a heap; short ones are merged side by side as rows of a matrix, the
best pair of each at every step. What is left and is no piece becomes byte pieces (or the unknown id, where the model has none). Units are remembered per worker
process, up to MEMO of them, their ids side by side in one array: a text is a row of unit numbers, and its ids are taken from there by numpy. No Python
object per id is made, since every worker of an executor may hold such a memory.

In every Arrow batch the sentencepiece library encodes each unit that is new to the worker,
one text as a whole, and decodes all ids; a difference stops the job, as it means a model that
is not of this type. The vocabulary (a file of fixed
size) is broadcast; whole texts are processed, a batch in slices of about SLICE_BYTES.

Defined cases: a null text counts as empty; an empty text has the end id only (no id without
`end`). Null ids decode to an empty text. Repeated rows are encoded one by one, and an empty
table gives an empty table. Columns beside the new one are kept, whatever their names.
"""

from __future__ import annotations

import codecs
import functools
import gc
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from weirstone.llm.common import mapped, slices

SPACE = "▁"
MEMO = 400_000
# Units up to SHORT characters are merged side by side, so many at a time; longer ones by a heap, and not remembered.
SHORT, TOGETHER = 32, 4096
NO_SYMBOL, PAD, NO_RANK, NO_PAIR = -1, -2, 1 << 30, 1 << 62
HASH = np.uint64(0x9E3779B97F4A7C15)
# An agenda entry: the rank above SHIFT bits of position.
SHIFT = 40
POSITION = (1 << SHIFT) - 1
# Bytes of text encoded at a time.
SLICE_BYTES = 1 << 20
# Numbers of ids decoded at a time.
DECODE_IDS = 1 << 19
UNKNOWN_TEXT = " ⁇ "
# Each byte that is no UTF-8 shows as one replacement character.
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


def library(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


class Memory:
    """Units by number, with the ids of all of them in one array."""

    def __init__(self):
        self.places: dict[str, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def __len__(self) -> int:
        return len(self.places)

    def __getitem__(self, unit: str) -> array:
        place = self.places[unit]
        return self.ids[self.ends[place] : self.ends[place + 1]]

    def add(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """New units; `ids` are theirs in a row, `sizes` how many each has."""
        self.places.update(zip(units, range(len(self), len(self) + len(units))))
        self.ends.frombytes((np.cumsum(sizes, dtype=np.int64) + len(self.ids)).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())

    def forget(self, units: Iterable[str]) -> None:
        """Drop `units`, which have to be the newest."""
        for unit in units:
            del self.places[unit]
        del self.ends[len(self) + 1 :]
        del self.ids[self.ends[-1] :]

    def since(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of the units after the first `count`."""
        ends = np.array(self.ends[count:], np.int64)
        return np.array(self.ids[ends[0] :], np.int32), np.diff(ends)

    def taken(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units at `places` in a row, and how many each has."""
        ends = np.frombuffer(self.ends, np.int64)
        starts = ends[places]
        sizes = ends[places + 1] - starts
        at = np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        return np.frombuffer(self.ids, np.int32)[at] if len(at) else np.zeros(0, np.int32), sizes


class Merger:
    """The agenda over one vocabulary."""

    def __init__(self, model: bytes):
        self.lib = lib = library(model)
        self.size = n = lib.get_piece_size()
        self.normal = {lib.id_to_piece(i): i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))}
        # Symbols are numbers: pieces by their ids, then characters that stand in pieces only.
        self.symbol = dict(self.normal)
        for c in sorted({c for piece in self.normal for c in piece}):
            self.symbol.setdefault(c, n + len(self.symbol))
        self.alone = {i: c for c, i in self.symbol.items() if i >= n}
        self.span = n + len(self.symbol) + 1
        # The heap takes the least: the best score has the least rank, equal scores share one.
        scores = {s: r for r, s in enumerate(sorted({lib.get_score(i) for i in self.normal.values()}, reverse=True))}
        self.rank, self.pair = {}, {}
        for piece, i in self.normal.items():
            for k in range(1, len(piece)):
                left, right = self.symbol.get(piece[:k]), self.symbol.get(piece[k:])
                if left is not None and right is not None:
                    self.rank[left * self.span + right] = scores[lib.get_score(i)]
                    self.pair[left * self.span + right] = i
        self.pair_keys, self.pair_ranks, self.pair_ids = self._table()
        self.symbol_of = np.full(0x110000, NO_SYMBOL, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.bytes = {int(lib.id_to_piece(i)[3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        self.border, self.before = None, []
        self.cut = self._cutter()
        self.memo = Memory()

    def _cutter(self) -> re.Pattern | None:
        """Units end before a space after another character, before a mark that follows a letter in no piece, and around characters of no merge."""
        follows = {(a, b) for piece in self.normal for a, b in zip(piece, piece[1:])}
        if any(a != SPACE and b == SPACE for a, b in follows):
            return None
        merging = {c for pair in follows for c in pair} - {SPACE}
        after_letters = {b for a, b in follows if a.isalnum()}
        letters = {c for c in merging if c.isalnum()}

        def listed(chars: set[str]) -> str:
            return "".join(map(re.escape, sorted(chars)))

        # A character of no merge: what follows it is encoded on its own.
        self.border = next(c for c in map(chr, range(10, 0x110000)) if c not in merging and c != SPACE and self.lib.normalize("a" + c)[-1] == c)
        self.before = self.lib.encode(self.border)
        marks, joining = listed(merging - letters), listed((merging - letters) & after_letters)
        word = f"[{listed(letters)}]+(?:[{joining}][{marks}]*)?" if joining else f"[{listed(letters)}]+"
        return re.compile(f"[^{listed(merging)}{SPACE}]+|{SPACE}*[{marks}]*(?:{word})*")

    def merged(self, unit: str) -> list[int]:
        """Ids of one unit, through a heap."""
        return self._ids(unit, self._by_heap(list(map(self.symbol.get, unit, repeat(NO_SYMBOL)))))

    def _ids(self, unit: str, symbols: list[int]) -> list[int]:
        """Symbols that are no pieces become bytes, or the unknown id."""
        strange = (c for c in unit if c not in self.symbol)
        found: list[int] = []
        for symbol in symbols:
            if 0 <= symbol < self.size:
                found.append(symbol)
                continue
            c = next(strange) if symbol == NO_SYMBOL else self.alone[symbol]
            if self.bytes:
                found += [self.bytes[b] for b in c.encode()]
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
        return found

    def _by_heap(self, symbols: list[int | None]) -> list[int]:
        """The agenda of a long unit: a heap of its pairs, those that are out of date being skipped."""
        rank, span, n = self.rank.get, self.span, len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # Entries are rank and position in one number.
        heap = [r << SHIFT | i for i, (a, b) in enumerate(pairwise(symbols)) if (r := rank(a * span + b)) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i = entry & POSITION
            j = after[i]
            # Out of date: one of the two has been merged since.
            if j >= n or symbols[i] is None or rank(key := symbols[i] * span + symbols[j]) != entry >> SHIFT:
                continue
            symbols[i] = new = self.pair[key]
            symbols[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank(new * span + symbols[k])) is not None:
                    heapq.heappush(heap, r << SHIFT | i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] * span + new)) is not None:
                heapq.heappush(heap, r << SHIFT | h)
        return [symbol for symbol in symbols if symbol is not None]

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, ranks and pieces of all pairs, each at its hash or in the next free slot after it; free ones hold -1."""
        bits = max(4, (4 * len(self.rank)).bit_length())
        self.hash_shift = np.uint64(64 - bits)
        keys, slots = np.array(list(self.rank), np.int64), np.full(1 << bits, -1, np.int64)
        for key, at in zip(keys.tolist(), self._slots(keys).tolist()):
            while slots[at] >= 0:
                at = (at + 1) % len(slots)
            slots[at] = key
        ranks = np.fromiter((self.rank.get(k, NO_RANK) for k in slots.tolist()), np.int32, len(slots))
        return slots, ranks, np.fromiter((self.pair.get(k, 0) for k in slots.tolist()), np.int32, len(slots))

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * HASH >> self.hash_shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols, NO_RANK where they form none."""
        keys = left.astype(np.int64) * self.span + right
        keys = np.where((left >= 0) & (right >= 0), keys, NO_PAIR)
        shape, keys = keys.shape, keys.ravel()
        place = self._slots(keys)
        held = self.pair_keys[place]
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            place[more] = (place[more] + 1) % len(self.pair_keys)
            held = self.pair_keys[place[more]]
            more = more[(held != keys[more]) & (held >= 0)]
        place = place.reshape(shape)
        return self.pair_ranks[place], self.pair_ids[place]

    def _side_by_side(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of similar length in a row, and how many each has. All are merged together: each step merges the best pair of every unit."""
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        width = int(lengths.max())
        columns = np.arange(width)
        symbols = np.full((len(units), width), PAD, np.int32)
        symbols[columns < lengths[:, None]] = self.symbol_of[np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)]
        ranks = np.full((len(units), width), NO_RANK, np.int32)
        made = np.zeros((len(units), width), np.int32)
        ranks[:, :-1], made[:, :-1] = self._ranks(symbols[:, :-1], symbols[:, 1:])
        going = np.arange(len(units))
        while len(going):
            own = ranks[going]
            at = own.argmin(axis=1)  # the first of equal ranks
            some = own[np.arange(len(going)), at] < NO_RANK
            going, at = going[some], at[some]
            if not len(going):
                break
            new = made[going, at]
            # The symbol and the pair after the place go; the others move up.
            take = np.minimum(columns + (columns > at[:, None]), width - 1)
            held = np.take_along_axis(symbols[going], take, axis=1)
            held[:, -1] = PAD
            row = np.arange(len(going))
            held[row, at] = new
            symbols[going] = held
            take = np.minimum(columns + (columns >= at[:, None]), width - 1)
            moved, kinds = np.take_along_axis(ranks[going], take, axis=1), np.take_along_axis(made[going], take, axis=1)
            moved[:, -1] = NO_RANK
            after = np.where(at + 1 < width, held[row, np.minimum(at + 1, width - 1)], PAD)
            moved[row, at], kinds[row, at] = self._ranks(new, after)
            inner = np.flatnonzero(at > 0)
            moved[inner, at[inner] - 1], kinds[inner, at[inner] - 1] = self._ranks(held[inner, at[inner] - 1], new[inner])
            ranks[going], made[going] = moved, kinds
        left = symbols != PAD
        flat, sizes = symbols[left], left.sum(axis=1)
        odd = np.flatnonzero((left & ((symbols < 0) | (symbols >= self.size))).any(axis=1))
        if not len(odd):
            return flat, sizes
        own = np.split(flat, np.cumsum(sizes)[:-1])
        for i in odd.tolist():
            own[i] = np.array(self._ids(units[i], own[i].tolist()), np.int32)
        return np.concatenate(own), np.fromiter(map(len, own), np.int64, len(own))

    def learn(self, units: set[str]) -> list[str]:
        """Merge new units, check them against the library, and remember them; those too long to stay come last and are returned."""
        before = len(self.memo)
        every = sorted(units, key=len)
        short = [u for u in every if 0 < len(u) <= SHORT]
        rest = [u for u in every if not 0 < len(u) <= SHORT]  # the empty unit first; it stays
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            self.memo.add(some, *self._side_by_side(some))
        for unit in rest:
            ids = self.merged(unit)
            self.memo.add([unit], np.array(ids, np.int32), np.array([len(ids)]))
        if self.cut is not None:
            self._check(short + rest, *self.memo.since(before))
        return [u for u in rest if u]

    def _check(self, units: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """The library's ids of each unit have to be these."""
        ends, skip = np.cumsum(sizes), len(self.before)
        for at in range(0, len(units), TOGETHER):
            some = units[at : at + TOGETHER]
            told = self.lib.encode([self.border + u.replace(SPACE, " ") for u in some], num_threads=1)
            own = ids[ends[at] - sizes[at] : ends[at + len(some) - 1]].tolist()
            want = [self.before + own[a:b] for a, b in pairwise([0, *np.cumsum(sizes[at : at + len(some)]).tolist()])]
            if told != want:
                raise _differ("ids", next(u for u, a, b in zip(some, told, want) if a != b))

    def encoded(self, texts: list[str], end: bool = False) -> pa.ListArray:
        """The ids of each text, with the end id if `end`."""
        # Lists of strings have no cycles; looking for some takes a fifth of the time.
        gc.disable()
        try:
            shown = map(self.lib.normalize, texts)
            units = [[t] for t in shown] if self.cut is None else list(map(self.cut.findall, shown))
            counts = np.fromiter(map(len, units), np.int64, len(units))
            flat = list(chain.from_iterable(units))
            del units
            places = self._places(flat)
            unknown = np.flatnonzero(places < 0)
            strange, long = list(map(flat.__getitem__, unknown.tolist())), []
            if strange:
                new = set(strange)
                if len(self.memo) + len(new) > MEMO:
                    self.memo = Memory()
                    unknown, strange, new = np.arange(len(flat)), flat, set(flat)
                long = self.learn(new)
                places[unknown] = self._places(strange)
            ids, sizes = self.memo.taken(places)
            self.memo.forget(long)
        finally:
            gc.enable()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)]
        if end:
            ids = np.insert(ids, ends, self.end)
            ends = ends + np.arange(1, len(ends) + 1)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))

    def _places(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.memo.places.get, units, repeat(-1)), np.int64, len(units))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return rows_of(self.encoded(texts))


class Reader:
    """Ids back to text."""

    def __init__(self, model: bytes):
        self.lib = lib = library(model)
        n = lib.get_piece_size()
        parts, lead = [], np.zeros(n, bool)
        for i in range(n):
            piece = lib.id_to_piece(i)
            if lib.is_control(i):
                parts.append(b"")
            elif lib.is_byte(i):
                parts.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_unknown(i):
                parts.append(UNKNOWN_TEXT.encode())
            else:
                parts.append(piece.replace(SPACE, " ").encode())
                lead[i] = piece.startswith(SPACE)
        self.parts, self.lead = pa.array(parts, pa.binary()), lead
        self.shown = np.array([bool(p) for p in parts])
        self.is_byte = np.array([lib.is_byte(i) for i in range(n)])
        # A space that the normaliser put before a text goes again.
        self.strips = lib.normalize("a") == SPACE + "a"

    def decode(self, ids: pa.ListArray) -> list[str]:
        ids = pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids
        flat, offsets = ids.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy())])
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.parts.take(flat)), b"").to_pylist()
        numbers = flat.to_numpy(zero_copy_only=False).astype(np.int64)
        # The first id of each row that shows.
        visible = np.flatnonzero(self.shown[numbers])
        at = np.append(visible, len(numbers))[np.searchsorted(visible, offsets[:-1])]
        first = np.append(numbers, -1)[at]
        strip = self.strips & (at < offsets[1:]) & (first >= 0) & self.lead[first]
        # Bytes on both sides of an id that does not show are no character together.
        hidden = np.flatnonzero(~self.shown[numbers[1:]] & self.is_byte[numbers[:-1]]) + 1
        apart = np.unique(np.searchsorted(offsets, hidden, "right") - 1)
        for i in apart.tolist():
            joined[i] = self._apart(numbers[offsets[i] : offsets[i + 1]])
        return [
            (b[1:] if s else b) if isinstance(b, str) else (b[1:] if s else b).decode("utf-8", "each_byte") for b, s in zip(joined, strip.tolist())
        ]

    def _apart(self, ids: np.ndarray) -> str:
        runs = np.split(ids, np.flatnonzero(~self.shown[ids]))
        return "".join(b"".join(self.parts.take(pa.array(run)).to_pylist()).decode("utf-8", "each_byte") for run in runs)


@functools.lru_cache(2)
def merger(model: bytes) -> Merger:
    """One per worker process, so that its memory outlives a task."""
    return Merger(model)


@functools.lru_cache(2)
def reader(model: bytes) -> Reader:
    return Reader(model)


def runs(column: pa.ListArray) -> Iterator[slice]:
    """Runs of rows with about DECODE_IDS ids; a longer row stands alone."""
    start = total = 0
    for i, size in enumerate(pc.fill_null(pc.list_value_length(column), 0).to_pylist()):
        if i > start and total + size > DECODE_IDS:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if len(column):
        yield slice(start, len(column))


def rows_of(column: pa.ListArray) -> list[list[int]]:
    """The lists of a column, null as empty; much faster than `to_pylist`."""
    flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _differ(what: str, where: object) -> RuntimeError:
    return RuntimeError(f"{what} differ from the sentencepiece library at {where!r}: not a merge-type model")


def encode(docs: DataFrame, model: bytes, *, text: str = "text", out: str = "ids", end: bool = True) -> DataFrame:
    """`docs` with the column `out` of piece ids (array of int), `end` adds the end id."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)
    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = merger(sent.value)
        for batch in batches:
            for part in slices(batch, place, SLICE_BYTES):
                texts = pc.fill_null(part.column(place), "").to_pylist()
                found = own.encoded(texts, end)
                # Units are checked when they are learnt, and how they are put together on a whole text; without units every text is.
                some = texts if own.cut is None else texts[:1]
                if rows_of(found[: len(some)]) != own.lib.encode(some, add_eos=end, num_threads=1):
                    raise _differ("ids", some[0][:100])
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=schema.fieldNames())

    return mapped(docs, run, schema)


def decode(rows: DataFrame, model: bytes, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`rows` with the column `out`: the text that the ids stand for."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    place = rows.columns.index(ids)
    schema = StructType([*rows.schema.fields, StructField(out, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = reader(sent.value)
        for batch in batches:
            for at in runs(batch.column(place)):
                part = batch.slice(at.start, at.stop - at.start)
                column = part.column(place)
                found = own.decode(column)
                want = own.lib.decode(rows_of(column), num_threads=1)
                if found != want:
                    raise _differ("texts", next(i for i, (a, b) in enumerate(zip(found, want)) if a != b))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], names=schema.fieldNames())

    return mapped(rows, run, schema)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
