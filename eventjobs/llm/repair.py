"""Repair of a conversation's structure by grammar-compressed dynamic programming.

A conversation is a sequence of symbols, one for each turn: the role's initial and the turn's fault. Re-Pair names the
most frequent pair of symbols again and again, over all sequences of a batch at once, so that what conversations have in
common is one rule. A symbol stands for a min-plus matrix over the states of the grammar (s?(ua)+)?: the cheapest
edits that lead from one state to another, with their audit as a rope (two halves, not copied). A rule's matrix is the
product of its two sides', made once, bottom-up, and used wherever the rule stands. Equal costs go to the least audit in
ASCII, which is right part by part: of two audits of the same turns and equal cost none begins with the other, as that
would be the other and some inserts.

Sorting is by ranges, so a conversation of any length is cut into runs that tasks evaluate by themselves, and the
matrices of its runs are multiplied where its texts are hashed, one turn after another. Only that last step, which a
digest of one whole text requires, has a conversation's turns in one task, as a stream that is not held.

Defined cases. Null ids, turns, roles and texts: ids and turns are one space in the checksum, roles and texts one space
altogether; null turns come first, rows of a null conv_id are one conversation. Turns that tie are ordered by role and
text digest; equal rows stand together, all but the first being duplicates. A role whose initial is not s, u or a cannot
be kept, nor can an empty one. Conversations without a turn after damage have zeros, an empty audit and the digest of
an empty text. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Costs of the edits, and what a truncated turn that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after s, after u, after a; where each role leads from each.
STATES, BEGIN, ENDS = 4, 0, (0, 3)
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: A turn's symbol is 4 * initial + fault.
INITIALS, FINE, BLANK, DUPLICATE, CUT = "sua?", 0, 1, 2, 3
#: Turns that a batch holds; below it Re-Pair sees them together.
GATHERED = 1 << 16
WHITE = r"\x20\x09-\x0D"


class Rope:
    """A text made of two ropes, or a short one; halves are shared between ropes."""

    __slots__ = ("left", "right", "text", "size")

    def __init__(self, left: Rope | None, right: Rope | None, text: str = ""):
        self.left, self.right, self.text = left, right, text
        self.size = len(text) if left is None else left.size + right.size

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if x.left is None:
                out.append(x.text)
            else:
                stack += (x.right, x.left)
        return "".join(out)


EMPTY = Rope(None, None)


def joined(a: Rope, b: Rope) -> Rope:
    return b if not a.size else a if not b.size else Rope(a, b)


def less(a: Rope, b: Rope) -> bool:
    """Whether a's text is before b's. Halves that both share at the same place are passed over unread."""
    one, two, rest_a, rest_b = [a], [b], "", ""
    while True:
        while not rest_a and not rest_b and one and two and one[-1] is two[-1]:
            one.pop()
            two.pop()
        if not rest_a and not rest_b and one and two and (one[-1].left is not None or two[-1].left is not None):
            # The longer one is taken apart first, so that equal halves come to stand beside one another.
            stack = one if two[-1].left is None or (one[-1].left is not None and one[-1].size >= two[-1].size) else two
            x = stack.pop()
            stack += (x.right, x.left)
            continue
        for stack, side in ((one, 0), (two, 1)):
            rest = rest_b if side else rest_a
            while not rest and stack:
                x = stack.pop()
                if x.left is None:
                    rest = x.text
                else:
                    stack += (x.right, x.left)
            if side:
                rest_b = rest
            else:
                rest_a = rest
        n = min(len(rest_a), len(rest_b))
        if not n:
            return len(rest_a) < len(rest_b)
        if rest_a[:n] != rest_b[:n]:
            return rest_a[:n] < rest_b[:n]
        rest_a, rest_b = rest_a[n:], rest_b[n:]


#: A matrix: for each pair of states the cost and the audit of the cheapest edits, or None.
Matrix = list[list[tuple[int, Rope] | None]]


def better(a: tuple[int, Rope] | None, b: tuple[int, Rope] | None) -> tuple[int, Rope] | None:
    if a is None or b is None:
        return a or b
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if less(b[1], a[1]) else a


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for i in range(len(a)):
        for k in range(STATES):
            if a[i][k] is None:
                continue
            for j in range(STATES):
                if b[k][j] is not None:
                    out[i][j] = better(out[i][j], (a[i][k][0] + b[k][j][0], joined(a[i][k][1], b[k][j][1])))
    return out[: len(a)]


def unit() -> Matrix:
    return [[(0, EMPTY) if i == j else None for j in range(STATES)] for i in range(STATES)]


def inserts() -> Matrix:
    """Any number of inserted turns; more than one of a state is never cheapest."""
    one = unit()
    rope = Rope(None, None, "I")
    for role in "ua":
        for i, j in NEXT[role].items():
            one[i][j] = better(one[i][j], (INSERT, rope))
    return product(product(one, one), one)


INSERTS = inserts()
_LETTERS = {x: Rope(None, None, x) for x in "KRD"}


def turn_matrix(symbol: int) -> Matrix:
    """What may be inserted before a turn, and what may be done to it."""
    initial, fault = INITIALS[symbol // 4], symbol % 4
    out: Matrix = [[(DELETE, _LETTERS["D"]) if i == j else None for j in range(STATES)] for i in range(STATES)]
    if fault in (FINE, CUT):
        more = TRUNCATED if fault == CUT else 0
        for role in "ua":
            for i, j in NEXT[role].items():
                out[i][j] = better(out[i][j], (REROLE + more, _LETTERS["R"]))
        for i, j in NEXT.get(initial, {}).items():
            out[i][j] = better(out[i][j], (KEEP + more, _LETTERS["K"]))
    return product(INSERTS, out)


TURNS = [turn_matrix(s) for s in range(4 * len(INITIALS))]


def repair_grammar(sequences: np.ndarray, at: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Re-Pair: the sequences (one after another, at: where each begins) with frequent pairs named from first on, until none comes twice; and the rules."""
    n = at.size - 1
    own = np.repeat(np.arange(n), np.diff(at))
    symbols, rules = sequences.astype(np.int64), []
    while symbols.size > 1:
        inside = own[:-1] == own[1:]
        codes = symbols[:-1] << 32 | symbols[1:]
        held, count = np.unique(codes[inside], return_counts=True)
        if not held.size or count.max() < 2:
            break
        pair = held[count.argmax()]
        hit = inside & (codes == pair)
        if pair >> 32 == pair & 0xFFFFFFFF:  # of overlapping ones every other, from the left of each run
            where = np.flatnonzero(hit)
            start = np.ones(where.size, dtype=bool)
            start[1:] = np.diff(where) > 1
            run = np.maximum.accumulate(np.where(start, np.arange(where.size), 0))
            hit[where[(np.arange(where.size) - run) % 2 == 1]] = False
        if hit.sum() < 2:  # an overlap only
            break
        rules.append((int(pair >> 32), int(pair & 0xFFFFFFFF)))
        symbols[:-1][hit] = first + len(rules) - 1
        stay = np.ones(symbols.size, dtype=bool)
        stay[1:][hit] = False
        symbols, own = symbols[stay], own[stay]
    return symbols, np.searchsorted(own, np.arange(n + 1)), rules


def evaluated(sequences: np.ndarray, at: np.ndarray) -> list[Matrix]:
    """Of each sequence of turn symbols its matrix: one for each rule, made bottom-up, and equal rests evaluated once."""
    symbols, at, rules = repair_grammar(sequences, at, len(TURNS))
    matrices = list(TURNS)
    for a, b in rules:
        matrices.append(product(matrices[a], matrices[b]))
    known: dict[bytes, Matrix] = {}
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        name = symbols[a:b].tobytes()
        if name not in known:
            m = unit()
            for s in symbols[a:b].tolist():
                m = product(m, matrices[s])
            known[name] = m
        out.append(known[name])
    return out


# The table's side: damage, faults, order.


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage that the checksum of conv_id:turn names; nulls are one space."""
    one = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.pmod(F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn")).cast("binary")), F.lit(20))
    rows = turns.select("conv_id", "turn", one("role").alias("role"), one("text").alias("text"), what.alias("what")).where("what <> 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "what")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("what") == 3, 2).otherwise(1)))).drop("what", "copy")


def fault(text: Column) -> Column:
    """blank, or truncated, by the text alone."""
    last = F.regexp_extract(text, rf"(?s)([^{WHITE}])[{WHITE}]*\z", 1)
    return F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT).otherwise(FINE)


RUN = "conv_id {id}, kind int, seq long, n long, audits binary, blank long, duplicate long, truncated long, illegal long, head string, tail string"
#: The initials that may stand beside one another.
LEGAL = {"su", "ua", "au"}
FOLLOWS = np.array([[x + y in LEGAL for y in INITIALS] for x in INITIALS])


def packed(m: Matrix) -> bytes:
    lines = []
    for i in range(STATES):
        for j in range(STATES):
            if m[i][j] is not None:
                lines.append(f"{i} {j} {m[i][j][0]} {m[i][j][1]}")
    return zlib.compress("\n".join(lines).encode(), 1)


def unpacked(data: bytes) -> Matrix:
    out: Matrix = [[None] * STATES for _ in range(STATES)]
    for line in zlib.decompress(data).decode().split("\n"):
        i, j, cost, audit = line.split(" ")
        out[int(i)][int(j)] = (int(cost), Rope(None, None, audit))
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns (conv_id, role, copies, fault, repeat) as runs: a conversation's turns as far as one batch has them, with their matrix and counts."""
    from pyspark import TaskContext

    seq = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        # A turn's copies may be many: they come in parts, of which the first has the turn itself.
        copies = batch.column(2).to_numpy()
        parts = -(-copies // GATHERED)
        at_row = np.repeat(np.arange(copies.size), parts)
        place = np.arange(at_row.size) - np.repeat(np.cumsum(parts) - parts, parts)
        sizes = np.minimum(copies[at_row] - place * GATHERED, GATHERED)
        whole_faults, whole_repeats = batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
        for a, b in gathered(sizes):
            low, high = int(at_row[a]), int(at_row[b - 1]) + 1
            roles, names, which = batch.column(1)[low:high].to_pylist(), batch.column(0)[low:high].to_pylist(), at_row[a:b] - low
            faults, repeats = whole_faults[low:high][which], whole_repeats[low:high][which]
            apart = np.cumsum([0] + [x != y for x, y in zip(names[:-1], names[1:], strict=True)])  # nulls are None
            letters = [r[:1] for r in roles]
            initials = np.array([INITIALS.find(x) if x in ("s", "u", "a") else 3 for x in letters])[which]
            first = np.where(faults == BLANK, BLANK, np.where(repeats | (place[a:b] > 0), DUPLICATE, faults))
            later = np.where(faults == BLANK, BLANK, DUPLICATE)
            whose = np.repeat(np.arange(b - a), sizes[a:b])
            begin = np.zeros(whose.size, dtype=bool)
            begin[np.cumsum(sizes[a:b]) - sizes[a:b]] = True
            found, initial, conv = np.where(begin, first[whose], later[whose]), initials[whose], apart[which][whose]
            at = np.searchsorted(conv, np.arange(apart[-1] + 2))
            broken = np.zeros(whose.size, dtype=bool)  # a turn that may not follow the one before it
            broken[1:] = (conv[1:] == conv[:-1]) & ~FOLLOWS[initial[:-1], initial[1:]]
            matrices = evaluated(initial * 4 + found, at)
            rows = []
            for k, (x, y) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                part, begins, last = found[x:y], which[whose[x]], which[whose[y - 1]]
                rows.append((names[begins], 1, seq, y - x, packed(matrices[k]), int((part == BLANK).sum()), int((part == DUPLICATE).sum()), int((part == CUT).sum()), int(broken[x:y].sum()), letters[begins], letters[last]))
                seq += 1
            columns = list(zip(*rows, strict=True))
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.string())
            names_of = [x.split()[0] for x in RUN.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names_of)


def gathered(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that stand for about GATHERED turns."""
    ends, a = np.cumsum(sizes), 0
    while a < sizes.size:
        b = min(sizes.size, max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + GATHERED))))
        yield a, b
        a = b


OUT = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Repair:
    """One conversation as its rows come: its counts, then its runs, then its turns."""

    def __init__(self, conv_id: object):
        self.conv_id, self.gaps, self.counts, self.tail = conv_id, 0, [0, 0, 0, 0], None
        self.paths: Matrix = [[(0, EMPTY) if j == BEGIN else None for j in range(STATES)]]
        self.audit: str | None = None
        self.cost, self.at, self.state, self.hash, self.lines = 0, 0, BEGIN, hashlib.sha256(), 0

    def run(self, audits: bytes, counts: list[int], head: str, tail: str) -> None:
        self.paths = product(self.paths, unpacked(audits))
        self.counts = [x + y for x, y in zip(self.counts, counts, strict=True)]
        if self.tail is not None and self.tail + head not in LEGAL:
            self.counts[3] += 1
        self.tail = tail

    def decide(self) -> None:
        if self.audit is None:
            found = product(self.paths, INSERTS)[0]
            best = None
            for j in ENDS:
                best = better(best, found[j])
            self.cost, self.audit = best[0], str(best[1])

    def line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        self.state = 3 if self.state == 2 else 1 if role[:1] == "s" and self.state == BEGIN else 2

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.line("assistant" if self.state == 2 else "user", "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.decide()
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self.line(role if edit == "K" else "assistant" if self.state == 2 else "user", text)

    def result(self) -> tuple:
        self.decide()
        self.inserted()
        return (self.conv_id, self.gaps, *self.counts, self.cost, self.audit, self.hash.hexdigest())


def _repaired(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The result of each conversation from rows sorted by conv_id, kind (0 counts, 1 runs, 2 turns) and order."""
    own: Repair | None = None
    done: list[tuple] = []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "gaps", "audits", "blank", "duplicate", "truncated", "illegal", "head", "tail", "role", "text")], strict=True):
            conv_id, kind, gaps, audits, blank, duplicate, truncated, illegal, head, tail, role, text = row
            if kind == 0:  # each conversation has one such row, its first
                if own is not None:
                    done.append(own.result())
                own = Repair(conv_id)
                own.gaps = gaps
            elif kind == 1:
                own.run(audits, [blank, duplicate, truncated, illegal], head, tail)
            else:
                own.turn(role, text)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), out, strict=True)], schema=out)
            done = []
    if own is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(own.result(), out, strict=True)], schema=out)


def repair(turns: DataFrame) -> DataFrame:
    """Of each conversation of turns (conv_id, turn, role, text; damaged already or not), as named in turns.conv_id: faults, cost, audit and digest of its repair.

    The conversations are those of turns; see repair_damaged for those that lost all turns."""
    return _repair(turns, turns.select("conv_id"))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The repair of conversations after damage; every original conv_id has a row."""
    return _repair(damaged(conversations), conversations.select("conv_id"))


def _repair(turns: DataFrame, everyone: DataFrame) -> DataFrame:
    kind = turns.schema["conv_id"].dataType.simpleString()
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").isNotNull().alias("has"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    # Equal rows of a turn are counted before anything is sorted, so a turn that repeats is no task's burden.
    light = written(rows.groupBy("conv_id", "has", "turn", "role", "digest").agg(F.count("*").alias("copies"), F.first(fault(F.col("text"))).alias("fault")))
    # The first turn of each (role, text) is no duplicate; a group of any size is one aggregate, and the join's key is one row on both sides.
    first = light.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("has", "turn")).alias("f"))
    first = first.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "f.*").withColumnsRenamed({"has": "_h", "turn": "_t"})
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")) & (F.col("has") == F.col("_h")) & (F.col("turn") == F.col("_t"))
    marked = light.join(first, same, "left").withColumn("repeat", F.col("_d").isNull())
    ordered = marked.repartitionByRange("conv_id", "has", "turn", "role", "digest").sortWithinPartitions("conv_id", "has", "turn", "role", "digest")
    runs = written(ordered.select("conv_id", "role", "copies", "fault", "repeat").mapInArrow(_runs, RUN.format(id=kind)))
    seen = light.where("has").groupBy("conv_id").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("n"))
    gaps = seen.select("conv_id", (F.col("high") - F.col("low") + 1 - F.col("n")).alias("gaps"))
    counted = everyone.groupBy("conv_id").agg(F.lit(0).cast("long").alias("gaps")).union(gaps).groupBy("conv_id").agg(F.sum("gaps").alias("gaps"))
    nothing = lambda *kinds: [F.lit(None).cast(k) for k in kinds]
    head = counted.select("conv_id", F.lit(0).alias("kind"), "gaps", F.lit(0).cast("long").alias("seq"), *[F.lit(None).cast(t).alias(c) for c, t in (("audits", "binary"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("head", "string"), ("tail", "string"), ("has", "boolean"), ("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"))])
    body = runs.select("conv_id", "kind", *nothing("long"), "seq", "audits", "blank", "duplicate", "truncated", "illegal", "head", "tail", *nothing("boolean", "long", "string", "binary", "string"))
    said = rows.select("conv_id", F.lit(2), *nothing("long", "long", "binary", "long", "long", "long", "long", "string", "string"), "has", "turn", "role", "digest", "text")
    stream = head.union(body).union(said).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "seq", "has", "turn", "role", "digest")
    ids = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if kind not in ids:
        raise ValueError(f"conv_id: a whole number or text is wanted, not {kind}")
    out = pa.schema([("conv_id", ids[kind]), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return stream.drop("seq", "has", "turn", "digest").mapInArrow(partial(_repaired, out=out), OUT.format(id=kind))
