"""Benchmark decontamination on templates.

Texts become tokens (words without surrounding punctuation, in lower case); numbers, names and units become typed
placeholders. Windows of the resulting template are hashed, and the documents' windows meet the benchmark's in a hash
join. Windows of one document and one item on one alignment are then taken together: each value that stood in a slot
of the item must have one value in the document, which accepts a question with other numbers and names, and not a
text that only has the shape. A document is contaminated where a consistent alignment covers enough of an item, or
where the windows of an alignment that repeat the item's own values do so by themselves. Windows of placeholders only
are hashed with their values, so that they match verbatim copies and nothing else.

A capital letter says name inside a sentence and nothing at its beginning, and where an item stands in a document moves
sentences and lines. Documents' words at a beginning are read both as a name and as a word; items' in every combination,
and all of an item's names as words once more, which finds copies without capitals (or all in capitals). A word that
is a name only by its second reading must be the same word in both texts.

A fixed-size bitmap of the benchmark's windows drops nearly all document windows where they are made; the join after
it is exact. The benchmark side is broadcast only while its windows are few, which is checked.

Defined cases. Null or empty texts and items match nothing; items with few literal words match their verbatim copies
only, and of items shorter than a window the whole template is the window. Longer ones may miss one token of theirs.
Very long texts are used whole, in memory of the longest. A null doc_id is judged like any other; rows that repeat a
doc_id are judged each by its own text; rows that repeat an item_id are texts of one item, of which each counts. Ties of items go to the smaller item_id. Other columns pass through; the new columns'
names give way to the new ones. An empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import NULL_DOC, Words, bitmap, in_bitmap, mix, powers, rolled, rows_by_bitmap, text_passes, trimmed, written

# Number words and units.
NUMBER_WORDS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
UNITS = "mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl l gal s sec secs min mins h hr hrs ms second seconds minute minutes hour hours day days week weeks month months year years meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters inch inches foot feet yard yards mile miles gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes liter liters litre litres gallon gallons dollar dollars euro euros cent cents percent degree degrees watt watts volt volts joule joules newton newtons mph kmh"
NUMBER, NAME, UNIT = 1, 2, 3
BROADCAST_WINDOWS = 300_000

_byte = np.arange(256)
_PUNCT = np.array([0x21 <= b < 0x7F and not chr(b).isalnum() for b in _byte])
_DIGIT = (_byte >= 0x30) & (_byte <= 0x39)
_UPPER = (_byte >= 0x41) & (_byte <= 0x5A)
_LETTER = _UPPER | (_byte >= 0x61) & (_byte <= 0x7A) | (_byte >= 0x80)
_STOP = np.isin(_byte, [ord(c) for c in ".!?:;"])


@dataclass(frozen=True)
class Params:
    """window: tokens. literals: tokens of an alignment that must not be placeholders where values differ (half of a shorter window). covered: tokens of an item that contaminate (all but one of a shorter one, all of one not longer than a window)."""

    window: int = 8
    literals: int = 4
    covered: int = 13


class Template:
    """Codes (hash or placeholder), slots (hash of a placeholder's value, else 0) and the first token of each text.

    values: hashes of all tokens. capital, either: tokens that may be names by their letters; words at a beginning."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts, hashed=False)
        raw = words.buf
        buf = raw.copy()
        buf[_UPPER[raw]] += 0x20
        after = np.zeros(buf.size, dtype=bool)
        after[1:] = raw[:-1] == 0xC3
        accented = after & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
        buf[accented] += 0x20
        starts, ends = trimmed(_PUNCT[buf], words.starts, words.ends)
        keep = starts < ends
        text = np.searchsorted(words.first, np.arange(starts.size), side="right") - 1
        # A sentence starts a text or line, or follows a stop.
        lines = np.concatenate([[0], np.cumsum(raw == 0x0A)])
        opens = np.ones(starts.size, dtype=bool)
        opens[1:] = (text[1:] != text[:-1]) | (lines[words.starts[1:]] != lines[words.ends[:-1]]) | _STOP[raw[words.ends[:-1] - 1]]
        starts, ends, text, opens = starts[keep], ends[keep], text[keep], opens[keep]
        words.buf = buf
        sums, down = words.prefix(), powers(buf.size)[1]
        hashes = mix((sums[ends] - sums[starts]) * down[starts])
        count = lambda mask: (lambda c: c[ends] - c[starts])(np.concatenate([[0], np.cumsum(mask)]))
        capital = _UPPER[raw]
        capital[:-1] |= accented[1:]
        digits, letters, capitals = count(_DIGIT[raw]), count(_LETTER[raw]), count(capital)
        number = (digits > 0) & ((letters == 0) | _DIGIT[raw[np.minimum(starts, raw.size - 1)]]) | np.isin(hashes, _hashes(NUMBER_WORDS))
        unit = np.isin(hashes, _hashes(UNITS))
        unit[1:] &= number[:-1] & (text[1:] == text[:-1])
        unit[:1] = False
        self.capital = capital[np.minimum(starts, raw.size - 1)] & (capitals == 1) & (letters > 1) & ~number & ~unit
        self.either = opens & (letters > 1) & ~number & ~unit
        self.values, self.text = hashes, text
        self.read(np.select([number, unit, self.capital & ~opens], [NUMBER, UNIT, NAME], 0))
        self.first = np.searchsorted(text, np.arange(len(texts) + 1))

    def read(self, kind: np.ndarray) -> None:
        self.kind = kind
        self.codes = np.where(kind == 0, self.values, kind.astype(np.uint64))
        self.slots = np.where(kind == 0, np.uint64(0), self.values | np.uint64(1))

    def other(self) -> Template:
        """The same texts with the words at a beginning that may be names as names."""
        t = copy(self)
        t.read(np.where(self.capital & self.either, NAME, self.kind))
        return t

    def part(self, a: int, b: int) -> Template:
        t = Template.__new__(Template)
        for name in ("values", "text", "capital", "either", "kind", "codes", "slots"):
            setattr(t, name, getattr(self, name)[a:b])
        return t

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the windows of n tokens, and their first tokens. Windows without a literal have their values in the hash."""
        if self.codes.size < n:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        plain = np.concatenate([[0], np.cumsum(self.slots == 0)])
        at = np.arange(self.codes.size - n + 1)
        good = self.text[at] == self.text[at + n - 1]
        hashes = rolled(self.codes, n)
        bare = good & (plain[at + n] == plain[at])
        if bare.any():
            hashes = np.where(bare, mix(rolled(self.codes ^ mix(self.slots), n)), hashes)
        return hashes[good] + np.uint64(n), at[good]


_lists: dict[str, np.ndarray] = {}


def _hashes(words: str) -> np.ndarray:
    if words not in _lists:
        _lists[words] = Words([words.encode()]).hashes
    return _lists[words]


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _readings(own: Template, n: int) -> tuple[Template, np.ndarray, list[int]]:
    """Windows of one item, each as a text of its own: with every choice of names among its words at a beginning, and without names.

    Also the tokens of each window that are names only by that choice, and its place."""
    at = np.arange(own.kind.size - n + 1)
    kinds, exact, places = [], [], []
    for x in at.tolist():
        kind, free = own.kind[x : x + n], np.flatnonzero(own.either[x : x + n])
        chosen = np.zeros((1 << free.size, n), dtype=bool)
        chosen[:, free] = np.arange(1 << free.size)[:, None] >> np.arange(free.size) & 1
        all_kinds = np.where(chosen, NAME, kind)
        if (kind == NAME).any():
            all_kinds = np.concatenate([all_kinds, np.where(kind == NAME, 0, kind)[None]])
            chosen = np.concatenate([chosen, np.zeros((1, n), dtype=bool)])
        kinds.append(all_kinds)
        exact.append(chosen)
        places += [x] * len(all_kinds)
    rows = np.array(places)
    t = Template.__new__(Template)
    t.values = own.values[rows[:, None] + np.arange(n)].ravel()
    t.text = np.repeat(np.arange(rows.size), n)
    t.read(np.concatenate(kinds).ravel())
    return t, np.concatenate(exact), places


def _item_windows(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        t = Template(_texts(batch.column(1)))
        rows = []
        for k, item in enumerate(batch.column(0).to_pylist()):
            a, b = t.first[k], t.first[k + 1]
            if b == a:
                continue
            own, n = t.part(a, b), min(p.window, int(b - a))
            part, exact, at = _readings(own, n)
            hashes, _ = part.windows(n)
            rows += [(int(np.int64(h.view(np.int64))), item, x, n, int(b - a), part.slots[k * n : k * n + n].view(np.int64).tolist(), exact[k].tolist()) for k, (h, x) in enumerate(zip(hashes, at, strict=True))]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["h", "item_id", "item_at", "width", "item_tokens", "item_slots", "exact"])


def _document_windows(batches: Iterator[pa.RecordBatch], p: Params, bits: np.ndarray, widths: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, _, texts in text_passes(batch.column(2)):
            first = Template(texts)
            second = first.other()
            changed = np.concatenate([[0], np.cumsum(first.kind != second.kind)])
            for n, t in [(n, t) for n in widths for t in (first, second)]:
                hashes, at = t.windows(n)
                hit = in_bitmap(bits, hashes.view(np.int64))
                if t is second:
                    hit &= changed[at + n] > changed[at]
                hashes, at = hashes[hit], at[hit]
                row = t.text[at]
                slots = t.slots[at[:, None] + np.arange(n)].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * n, pa.int32()), pa.array(slots.ravel()))
                rows = pa.array(row + a)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(at - t.first[row]), lists], names=["h", "doc_key", "text_hash", "at", "slots"])


NEW = ["contaminated", "item_id", "n_items", "matched_tokens"]


def contaminated(documents: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """doc_key (doc_id, null as the least long), text_hash, item_id (of the longest match), n_items, matched_tokens of the contaminated rows of documents."""
    items = written(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_item_windows, p=p), "h long, item_id long, item_at long, width long, item_tokens long, item_slots array<long>, exact array<boolean>"))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most as many as a window has tokens
    keyed = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("doc_key"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    hits = keyed.mapInArrow(partial(_document_windows, p=p, bits=bitmap(items, "h"), widths=widths), "h long, doc_key long, text_hash long, at long, slots array<long>")
    few = items.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS
    met = hits.join(F.broadcast(items) if few else items, "h")
    three = F.arrays_zip("item_slots", "slots", "exact")
    met = met.where(F.forall(three, lambda x: ~x["exact"] | (x["item_slots"] == x["slots"])))
    pairs = F.transform(F.filter(three, lambda x: (x["item_slots"] != 0) & ~x["exact"]), lambda x: x.dropFields("exact"))
    words = F.filter(F.transform(three, lambda x, k: F.when((x["item_slots"] == 0) | x["exact"], F.col("item_at") + k)), lambda x: x.isNotNull())
    same = F.when(F.col("item_slots") == F.col("slots"), F.col("item_at"))
    # The sets hold at most one entry for each window of the item, or each placeholder of it, and are made before the shuffle, too.
    lines = met.groupBy("doc_key", "text_hash", "item_id", "item_tokens", "width", (F.col("at") - F.col("item_at")).alias("line")).agg(
        F.array_sort(F.collect_set("item_at")).alias("places"), F.array_sort(F.collect_set(same)).alias("same"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"), F.size(F.array_distinct(F.flatten(F.collect_set(words)))).alias("words")
    )
    width = F.col("width")
    covered = lambda places: F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + x + width - F.greatest(acc["end"], x)).alias("n"), (x + width).alias("end")),
        lambda acc: acc["n"],
    )
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda x: x["item_slots"]))) == F.size("pairs")
    literal = F.col("words") >= F.greatest(F.lit(1), F.least(F.lit(p.literals), F.floor(width / 2)))
    n = F.when(consistent & literal, covered("places")).otherwise(covered("same"))
    enough = F.least(F.lit(p.covered), F.when(F.col("item_tokens") > p.window, F.col("item_tokens") - 1).otherwise(F.col("item_tokens")))
    found = lines.select("doc_key", "text_hash", "item_id", "item_tokens", n.alias("n"), enough.alias("enough")).where("n >= enough")
    best = F.min(F.struct((-F.col("n")).alias("n"), "item_id"))
    return found.groupBy("doc_key", "text_hash").agg(best.alias("best"), F.count_distinct("item_id").alias("n_items")).select("doc_key", "text_hash", F.col("best.item_id").alias("item_id"), "n_items", (-F.col("best.n")).alias("matched_tokens"))


def judge_contamination(documents: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """documents with contaminated (boolean), item_id, n_items and matched_tokens (null, 0, 0 for clean rows)."""
    found = contaminated(documents, benchmark, p)
    others = [c for c in documents.columns if c not in NEW]
    named = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)).alias("__key"), F.xxhash64("text").alias("__hash"), *others)
    joined = named.join(found, (F.col("__key") == F.col("doc_key")) & (F.col("__hash") == F.col("text_hash")), "left")
    return joined.select(*others, F.col("doc_key").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("matched_tokens", F.lit(0)).alias("matched_tokens"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of documents that are not contaminated. Only those that may be are shuffled."""
    found = written(contaminated(documents, benchmark, p).select("doc_key", "text_hash"))
    bits = bitmap(found.select(F.xxhash64("doc_key", "text_hash").alias("h")), "h")
    key, text_hash = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC)), F.xxhash64("text")
    keyed = documents.select(F.xxhash64(key, text_hash).alias("__h"), key.alias("__key"), text_hash.alias("__hash"), *documents.columns)
    doubtful = rows_by_bitmap(keyed, bits, True).join(found, (F.col("__key") == F.col("doc_key")) & (F.col("__hash") == F.col("text_hash")), "left_anti")
    return rows_by_bitmap(keyed, bits, False).union(doubtful).select(*documents.columns)
