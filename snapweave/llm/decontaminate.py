"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised (A-Z lower-cased, words of letters, digits and non-ASCII
characters) and put into one suffix automaton over word numbers.  Documents
stream through it word by word; the state gives the longest run of words ending
here that some item contains.  A run of ``window`` words is a hit of every item
that has this window; an item with fewer words is one window of its own.

Automata are built in tasks and written to the shared folder, each over at most
``shard_words`` item words, so a benchmark of any size has its automata and a task
holds one at a time; the driver only sees their names.  An item above that size
is cut into pieces that overlap by a window less a word, which loses no window.

Defined results: a null text has no words, so no hit; an item without words or
a null item has no window; items that repeat an id count once; a null item id
marks words as hit but is not listed; an empty benchmark hits nothing; rows are
judged one by one, so repeated rows and other columns do not matter; the longest
match is followed within one piece of an item.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted
from .files import committed, new_folder, open_folder

# Every ASCII character that is not a digit or a letter separates words.
SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
NORMAL = bytes(0x20 if b in SEPARATORS else (b + 32 if 0x41 <= b <= 0x5A else b) for b in range(256))
ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # before A-Z are lower-cased
WORD = re.compile("[^ ]+")      # in normalised text


@dataclass(frozen=True)
class DecontaminationParams:
    window: int = 10
    shard_words: int = 200_000    # one automaton, about 150 MB in a task
    max_coverage: float = 0.5     # a document with more of its words hit is dropped


def words_of(text: bytes | None) -> list[bytes]:
    # only ASCII bytes are mapped, so the one white space left is the separator
    return text.translate(NORMAL).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences, with the windows' items at its states."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set] = [set()]          # of states whose strings end in a window
        self.ids: list[str | None] = []
        shorts: list[tuple[int, int]] = []
        sequences = []
        for item_id, words in items:
            if words:
                number = len(self.ids)
                self.ids.append(item_id)
                sequences.append((number, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]))
        ends: list[tuple[int, int]] = []
        for number, seq in sequences:
            last = 0
            for at, c in enumerate(seq):
                last = self._extend(last, c)
                if at + 1 >= window:
                    ends.append((last, number))
            if len(seq) < window:
                shorts.append((number, len(seq)))
        self._place(ends, shorts, dict(sequences))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        new = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        self.items.append(set())
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.items.append(set())
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _owner(self, state: int, size: int) -> int:
        """The state on the link path that holds the suffix of ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _place(self, ends, shorts, sequences) -> None:
        # construction may have cloned a state since its position was noted, but the
        # noted state still ends in the same words, so its link path has the owner
        for state, number in ends:
            self.items[self._owner(state, self.window)].add(number)
        self.short: list[tuple] = [()] * len(self.next)   # (words, item) of short items that end here
        for number, size in shorts:
            state = 0
            for c in sequences[number]:
                state = self.next[state][c]
            self.short[state] += ((size, number),)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] += self.short[self.link[state]]
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if not self.items[state] and self.length[self.link[state]] >= self.window:
                self.items[state] = self.items[self.link[state]]   # shared, not copied

    def scan(self, words: list[bytes], hits: bytearray | None, found: set) -> tuple[bytearray | None, int]:
        """Mark the words inside windows; add the items' numbers; the longest match length."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = size = longest = 0
        get = self.vocabulary.get
        for at, word in enumerate(words):
            c = get(word)
            if c is None:
                state = size = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            state = nxt[state].get(c, 0)
            size = size + 1 if state else 0
            if size > longest:
                longest = size
            if size >= window:
                if hits is None:
                    hits = bytearray(len(words))
                hits[at - window + 1:at + 1] = b"\x01" * window
                owner = state if length[link[state]] < window else self._owner(state, window)
                found |= self.items[owner]
            if self.short[state]:
                for k, number in self.short[state]:
                    if k <= size:
                        if hits is None:
                            hits = bytearray(len(words))
                        hits[at - k + 1:at + 1] = b"\x01" * k
                        found.add(number)
        return hits, longest


def pack_items(rows: Iterable[tuple[str | None, bytes]], p: DecontaminationParams) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items in groups of at most ``shard_words`` words, longer items in overlapping pieces."""
    limit, overlap = max(p.shard_words, p.window), p.window - 1
    part, size = [], 0
    for item_id, text in rows:
        words = words_of(text)
        for at in range(0, max(len(words) - overlap, 1), limit - overlap):
            piece = words[at:at + limit]
            if part and size + len(piece) > limit:
                yield part
                part, size = [], 0
            part.append((item_id, piece))
            size += len(piece)
    if part:
        yield part


def write_shards(benchmark: DataFrame, params: DecontaminationParams, item_id: str = "item_id",
                 text: str = "text") -> tuple[str, list[str]]:
    """The folder of the automata's files and their names; tasks build and write them.

    Items are dealt to shards by hash, copies of one text under several ids as well.
    A repeated task packs its items in the same order, so it writes the same files.
    """
    folder = new_folder(benchmark.sparkSession, "automata")
    items = (benchmark.where(F.col(quoted(text)).isNotNull())
             .select(F.col(quoted(item_id)).cast("string").alias("id"), F.col(quoted(text)).cast("string").alias("text")))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(ITEM_WORD)))).first()[0] or 0
    if not total:
        return folder, []
    # a quarter more shards than full ones, so few spill into a second file
    shards = 1 if total <= params.shard_words else -(-5 * total // (4 * params.shard_words))
    dealt = items.distinct().withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)))

    def build(found: pa.Table) -> pa.Table:
        shard = found.column("shard")[0].as_py()
        rows = sorted(zip(found.column("id").to_pylist(), found.column("text").to_pylist(), strict=True),
                      key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        names = []
        for k, part in enumerate(pack_items(((i, t.encode()) for i, t in rows), params)):
            names.append(f"{shard}-{k}")
            with committed(folder, names[-1]) as out:
                pickle.dump(Automaton(part, params.window), out)
        return pa.table({"name": pa.array(names, pa.string())})

    names = dealt.groupBy("shard").applyInArrow(build, "name string")
    return folder, sorted(r["name"] for r in names.collect())


SCHEMA = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()),
                    ("items", pa.list_(pa.string())), ("clean", pa.string())])


class _Found:
    """What the shards have found in one text."""

    __slots__ = ("data", "n_words", "hits", "ids", "longest")

    def __init__(self, data: bytes | None):
        self.data, self.n_words, self.hits, self.ids, self.longest = data, 0, None, set(), 0

    def add(self, automaton: Automaton) -> None:
        words = words_of(self.data)
        self.n_words = len(words)
        numbers: set[int] = set()
        self.hits, run = automaton.scan(words, self.hits, numbers)
        self.ids |= {automaton.ids[k] for k in numbers} - {None}
        self.longest = max(self.longest, run)


def _cut(data: bytes, hits: bytearray) -> bytes:
    """The text without the stretches from the first to the last word of each hit run."""
    text, out, at, k = data.decode("utf-8", "replace"), [], 0, 0
    spans = [m.span() for m in WORD.finditer(data.translate(NORMAL).decode("utf-8", "replace"))]
    while k < len(spans):
        if hits[k]:
            first = k
            while k < len(spans) and hits[k]:
                k += 1
            out.append(text[at:spans[first][0]])
            at = spans[k - 1][1]
        k += 1
    out.append(text[at:])
    return "".join(out).encode()


def _scanner(folder: str, names: list[str], cut: bool):
    def opened(name: str) -> Automaton:
        fs, path = open_folder(folder)
        with fs.open_input_stream(f"{path}/{name}", compression=None) as file:
            return pickle.loads(file.read())

    def find(rows: list[_Found], load) -> None:
        for name in names:
            automaton = load(name)
            for row in rows:
                row.add(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a single shard stays loaded; of several, one is held at a time
        only = opened(names[0]) if len(names) == 1 else None

        def load(name: str) -> Automaton:
            return only if only is not None else opened(name)

        for batch in batches:
            keys = batch.select(range(batch.num_columns - 1))
            rows = [_Found(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            find(rows, load)
            if not names:
                for r in rows:
                    r.n_words = len(words_of(r.data))
            counts = [sum(r.hits) if r.hits else 0 for r in rows]
            clean = [None] * len(rows)
            if cut:
                dirty = [r for r in rows if r.hits]
                while dirty:  # joining what is left may make a new window
                    again = [_Found(_cut(r.data, r.hits)) for r in dirty]
                    find(again, load)
                    for old, new in zip(dirty, again, strict=True):
                        old.data, old.hits = new.data, new.hits
                    dirty = [r for r in dirty if r.hits]
                clean = [None if r.data is None else r.data.decode("utf-8", "replace") for r in rows]
            columns = [[r.n_words for r in rows], counts, [r.longest for r in rows], [sorted(r.ids) for r in rows], clean]
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, *(pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True))],
                names=[*keys.schema.names, *SCHEMA.names])
    return run


def _scan(docs: DataFrame, text: str, benchmark: DataFrame, p: DecontaminationParams, cut: bool) -> DataFrame:
    """``docs`` without the text column, plus the scan's columns (names of position, so none clash)."""
    folder, names = write_shards(benchmark, p)
    others = [c for c in docs.columns if c != text]
    narrow = docs.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(others)],
                         F.col(quoted(text)).cast("binary").alias("t"))
    fields = [f"c{i} {narrow.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(others))]
    schema = ", ".join([*fields, "n_words long, n_hit long, longest long, items array<string>, clean string"])
    return narrow.mapInArrow(_scanner(folder, names, cut), schema)


def contamination(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams(),
                  doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, the items found and the longest matching run of words."""
    narrow = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    out = _scan(narrow, "text", benchmark, params, cut=False)
    return out.select(F.col("c0").alias("doc_id"), "n_words", "n_hit", "items", F.col("longest").alias("longest_match"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: DecontaminationParams = DecontaminationParams(),
                  text: str = "text") -> DataFrame:
    """``docs`` with contaminated spans removed; documents over the coverage limit go.

    A hit run is at least one window, or a whole shorter item, so each is over the
    length limit.
    """
    others = [c for c in docs.columns if c != text]
    out = _scan(docs, text, benchmark, params, cut=True)
    kept = out.where((F.col("n_hit") <= params.max_coverage * F.col("n_words")))
    return kept.select(*[(F.col("clean") if c == text else F.col(f"c{others.index(c)}")).alias(c) for c in docs.columns])
