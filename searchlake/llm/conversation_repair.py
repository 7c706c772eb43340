"""Conversation structure repair (operator 11): grammar-compressed min-plus DP.

A conversation's rows, in order of turn, become symbols: the role's initial
and the row's fault.  The cheapest edits that make the initials match
``(s?(ua)+)?`` are a shortest path through four states (nothing yet, after s,
after u, after a), so a symbol is a 4 x 4 min-plus matrix whose entries hold a
cost and an audit: the edits' initials, as a rope.  Matrices of adjacent
symbols multiply.

Symbol sequences are compressed by Re-Pair: the most frequent pair of symbols
becomes a rule, until no pair occurs twice.  Each rule has one matrix, the
product of its two sides, evaluated once and shared by all conversations of
the task.

An entry's audit ends with an edit that consumes a row; insertions stand
before such an edit or at the very end.  So of two audits over the same rows
neither continues the other, and the ASCII-least of a product is the product
of the ASCII-least.

Conversations are dealt to tasks by id and streamed in order.  Those with
more than ``LONG_ROWS`` rows or ``LONG_BYTES`` bytes are cut into ordered
chunks by a range shuffle instead: chunks are evaluated apart, one small
matrix each, and the matrices of a conversation are folded.  What the fold
holds is about the audit that the result row holds.  SHA-256 is sequential,
so the last step streams such a conversation's rows through one task, sorted
on disk and never held.

Defined cases: a null role or text is one space (so a null text is blank, and
a null role, as any initial but s, u and a, can't be kept).  Rows of equal turn
are ordered by role, then text; a null turn comes first.  Equal rows are
interchangeable.  A null conversation id is a conversation of its own.  A
conversation without rows has zeros, an empty audit and the hash of an empty
string.  An empty table gives an empty result.  Only the four named columns
(and the copies) are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from searchlake.llm.common import slices, written

#: Beyond these a conversation is cut into chunks of about as many rows.
LONG_ROWS, LONG_BYTES = 10_000, 8 << 20

#: Rows and bytes of conversations that share one grammar.
POOL_ROWS, POOL_BYTES = 50_000, 8 << 20

#: Rules that a task remembers.
RULES = 200_000

REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3

BLANK = r"[^\x20\x09-\x0D]"
ENDED = r"[.!?][\x20\x09-\x0D]*\z"

# --- ropes and matrices ------------------------------------------------------------

#: A rope is a string or a pair of ropes.
Rope = "str | tuple"

#: An entry (cost, rope) for each reachable (state, state).
Matrix = dict

START, S, U, A = range(4)
_NEXT_ROLE = {START: U, S: U, A: U, U: A}
_CLOSE = {START: (0, ""), S: (2 * INSERT, "II"), U: (INSERT, "I"), A: (0, "")}


def leaves(rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            yield top
        else:
            stack += (top[1], top[0])


def flat(rope) -> str:
    return "".join(leaves(rope))


def before(a, b) -> bool:
    """Whether rope ``a`` is ASCII-less than rope ``b``."""
    while not isinstance(a, str) and not isinstance(b, str) and a[0] is b[0]:
        a, b = a[1], b[1]
    if a is b:
        return False
    left, right, x, y = leaves(a), leaves(b), "", ""
    while True:
        x = x or next((s for s in left if s), "")
        y = y or next((s for s in right if s), "")
        n = min(len(x), len(y))
        if not n or x[:n] != y[:n]:
            return x[:n] < y[:n] if n else bool(y) and not x
        x, y = x[n:], y[n:]


def _put(into: dict, key, cost: int, rope) -> None:
    old = into.get(key)
    if old is None or cost < old[0] or cost == old[0] and before(rope, old[1]):
        into[key] = (cost, rope)


def _insertions() -> dict:
    """(state, state) -> the insertions on the way."""
    out = {}
    for q in range(4):
        state, letters = q, ""
        while (q, state) not in out:
            out[q, state] = letters
            state, letters = _NEXT_ROLE[state], letters + "I"
    return out


_INSERTIONS = _insertions()


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    """0 for a row that must go, else one of eight."""
    return 0 if must_go else 1 + 2 * "sua".find(initial if initial else "?") + 2 + int(truncated)


def symbol_matrix(code: int) -> Matrix:
    """The cheapest ways from state to state over one row."""
    out: Matrix = {}
    for (q, r), letters in _INSERTIONS.items():
        cost = INSERT * len(letters)
        _put(out, (q, r), cost + DELETE, letters + "D")
        if not code:
            continue
        role, cut = (code - 1) // 2 - 1, CUT * ((code - 1) % 2)
        if role == 0 and r == START:
            _put(out, (q, S), cost + cut, letters + "K")
        if role == _NEXT_ROLE[r] - 1 and role > 0:
            _put(out, (q, _NEXT_ROLE[r]), cost + cut, letters + "K")
        _put(out, (q, _NEXT_ROLE[r]), cost + cut + REROLE, letters + "R")
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (q, r), (cost, rope) in a.items():
        for s in range(4):
            more = b.get((r, s))
            if more is not None:
                _put(out, (q, s), cost + more[0], (rope, more[1]))
    return out


def closed(vector: dict) -> tuple[int, str]:
    """The cheapest edits from entries by state, closing insertions included."""
    ends: dict = {}
    for q, (cost, rope) in vector.items():
        _put(ends, 0, cost + _CLOSE[q][0], (rope, _CLOSE[q][1]))
    return ends[0][0], flat(ends[0][1])


class Grammar:
    """Rules (pairs of symbols) and their matrices; terminals are 0 to 8."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.rules: dict[tuple[int, int], int] = {}
        self.matrices: list[Matrix] = [symbol_matrix(c) for c in range(9)]

    def rule(self, pair: tuple[int, int]) -> int:
        """The symbol of a rule, its matrix evaluated bottom-up once."""
        code = self.rules.get(pair)
        if code is None:
            code = self.rules[pair] = len(self.matrices)
            self.matrices.append(product(self.matrices[pair[0]], self.matrices[pair[1]]))
        return code

    def compress(self, sequences: list[list[int]]) -> list[list[int]]:
        """The sequences after Re-Pair: no pair of symbols occurs twice."""
        text: list[int] = []
        for s in sequences:
            text += s
            text.append(-1)
        n = len(text)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[tuple[int, int], set[int]] = defaultdict(set)

        def pair_at(i: int) -> tuple[int, int] | None:
            j = after[i] if 0 <= i < n else n
            return (text[i], text[j]) if j < n and text[i] >= 0 and text[j] >= 0 else None

        def note(i: int) -> None:
            pair = pair_at(i)
            # Pairs of one symbol with itself don't overlap.
            if pair and not (pair[0] == pair[1] and prior[i] >= 0 and prior[i] in places[pair]):
                places[pair].add(i)
                queue[len(places[pair])].add(pair)

        def forget(i: int) -> None:
            pair = pair_at(i)
            if pair:
                places[pair].discard(i)

        queue: dict[int, set] = defaultdict(set)
        for i in range(n):
            note(i)
        size = max((len(p) for p in places.values()), default=0)
        while size > 1:
            if not queue[size]:
                size -= 1
                continue
            pair = queue[size].pop()
            found = places[pair]
            if len(found) != size:
                if len(found) > 1:
                    queue[len(found)].add(pair)
                continue
            code = self.rule(pair)
            for i in sorted(found):
                j = after[i]
                if j >= n or (text[i], text[j]) != pair:
                    continue
                forget(prior[i])
                forget(j)
                text[i], text[j] = code, -2
                after[i] = after[j]
                if after[j] < n:
                    prior[after[j]] = i
                note(prior[i])
                note(i)
            places.pop(pair, None)
        out, own, i = [], [], 0
        while i < n:
            if text[i] < 0:
                out.append(own)
                own = []
            else:
                own.append(text[i])
            i = after[i]
        return out

    def solve(self, sequences: set[tuple[int, ...]]) -> dict[tuple[int, ...], tuple[int, str]]:
        """Cost and audit of each sequence."""
        if len(self.matrices) > RULES:
            self.forget()
        keys = sorted(sequences)
        out = {}
        for key, short in zip(keys, self.compress([list(k) for k in keys])):
            vector = {START: (0, "")}
            out[key] = closed(self.step(vector, self.whole(short)) if short else vector)
        return out

    def whole(self, short: list[int]) -> Matrix:
        """The matrix of a compressed sequence, as a balanced product."""
        row = [self.matrices[code] for code in short]
        while len(row) > 1:
            pairs = [product(a, b) for a, b in zip(row[::2], row[1::2])]
            row = pairs + row[len(pairs) * 2 :]
        return row[0]

    @staticmethod
    def step(vector: dict, matrix: Matrix) -> dict:
        """The entries by state after one more matrix."""
        out: dict = {}
        for (q, r), (cost, rope) in matrix.items():
            if q in vector:
                _put(out, r, vector[q][0] + cost, (vector[q][1], rope))
        return out


class Replay:
    """Applies an audit to rows: the repaired rows, one after the other."""

    def __init__(self):
        self.state = START

    def insert(self) -> tuple[str, str]:
        self.state = _NEXT_ROLE[self.state]
        return ("user" if self.state == U else "assistant"), ""

    def edit(self, letter: str, role: str, text: str) -> tuple[str, str] | None:
        if letter == "D":
            return None
        if letter == "R":
            return self.insert()[0], text
        self.state = 1 + "sua".index(role[0])
        return role, text


# --- rows ----------------------------------------------------------------------


def prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """``conv, turn, role, text, copies, blank, ended``; nulls are one space."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(" "))
    out = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), said.alias("text"),
        (F.col(copies).cast("long") if copies else F.lit(1).cast("long")).alias("copies"),
    )
    return out.withColumn("blank", ~F.col("text").rlike(BLANK)).withColumn("ended", F.col("text").rlike(ENDED))


def _order() -> list[Column]:
    return [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


class Tally:
    """What is counted over a conversation's rows in order."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first: str | None = None
        self.last: str | None = None
        self.codes: list[int] = []

    def add(self, role: str, blank: bool, ended: bool, fresh: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        gone, cut = blank or not fresh, not ended
        self.blank += blank
        self.duplicate += not blank and not fresh
        self.truncated += not gone and cut
        self.codes.append(symbol(initial, gone, cut))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ROWS = "place long, edit string, role string, text string"


class Reports:
    """Collects one report row for each conversation."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, conv, tally: Tally, turns: set, cost: int, audit: str, rows: Iterable[tuple[str, str, str]]) -> None:
        digest = hashlib.sha256()
        for place, (_, role, text) in enumerate(rows):
            digest.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        self.rows.append((conv, gaps, tally.blank, tally.duplicate, tally.truncated, tally.illegal, cost, audit, digest.hexdigest()))


class Turns:
    """Collects the repaired rows themselves."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, conv, tally: Tally, turns: set, cost: int, audit: str, rows: Iterable[tuple[str, str, str]]) -> None:
        self.rows += [(conv, place, edit, role, text) for place, (edit, role, text) in enumerate(rows)]


def replayed(audit: str, rows: list[tuple]) -> Iterator[tuple[str, str, str]]:
    """``(edit, role, text)`` of the repaired conversation."""
    replay, at = Replay(), iter(rows)
    for letter in audit:
        if letter == "I":
            yield ("I", *replay.insert())
        else:
            role, text = next(at)
            kept = replay.edit(letter, role, text)
            if kept:
                yield (letter, *kept)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Whole conversations out of sorted batches."""
    names = ["turn", "role", "text", "copies", "blank", "ended"]
    conv, rows, some = None, [], False
    for batch in slices(batches):
        columns = [batch.column(n).to_pylist() for n in names]
        for key, *row in zip(batch.column("conv").to_pylist(), *columns):
            if some and key != conv:
                yield conv, rows
                rows = []
            conv, some = key, True
            rows.append(row)
    if some:
        yield conv, rows


def _repair_pool(pool: list[tuple[object, list[tuple]]], grammar: Grammar, sink) -> None:
    """All conversations of the pool under one grammar."""
    work = []
    for conv, rows in pool:
        tally, turns, seen, kept = Tally(), set(), set(), []
        for turn, role, text, copies, blank, ended in rows:
            for _ in range(copies):
                tally.add(role, blank, ended, (role, text) not in seen)
                seen.add((role, text))
                kept.append((role, text))
            if copies and turn is not None:
                turns.add(turn)
        work.append((conv, tally, turns, kept, tuple(tally.codes)))
    solved = grammar.solve({codes for *_, codes in work})
    for conv, tally, turns, kept, codes in work:
        cost, audit = solved[codes]
        sink.add(conv, tally, turns, cost, audit, replayed(audit, kept))


def _task(make_sink, schema: pa.Schema):
    """Task function over whole, sorted conversations of bounded size."""

    def table(sink) -> pa.RecordBatch:
        columns = list(zip(*sink.rows)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, pool, n, size = Grammar(), [], 0, 0
        for conv, rows in _conversations(batches):
            pool.append((conv, rows))
            n, size = n + len(rows), size + sum(len(r[2]) for r in rows)
            if n >= POOL_ROWS or size >= POOL_BYTES:
                sink = make_sink()
                _repair_pool(pool, grammar, sink)
                pool, n, size = [], 0, 0
                yield table(sink)
        sink = make_sink()
        _repair_pool(pool, grammar, sink)
        yield table(sink)

    return run


# --- long conversations ----------------------------------------------------------


def long_conversations(rows: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """``conv`` of the conversations to cut, at most one for each
    ``most_rows`` rows or ``most_bytes`` bytes of the input."""
    size = F.sum(F.octet_length("text") + F.octet_length("role"))
    sizes = rows.groupBy("conv").agg(F.sum("copies").alias("n"), size.alias("size"))
    return written(sizes.where((F.col("n") > most_rows) | (F.col("size") > most_bytes)).select("conv"), "long-conversations")


def _with_chunks(rows: DataFrame, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Long conversations' rows in order, equal rows once with their number:
    ``conv, chunk, seq, turn, role, text, copies, blank, ended, fresh``.
    Chunks ascend with the order of rows."""
    equal = rows.groupBy("conv", "turn", "role", "text", "blank", "ended").agg(F.sum("copies").alias("copies"))
    equal = written(equal.withColumn("said", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)), "long-rows")
    first = equal.groupBy(F.col("conv").alias("c"), F.col("said").alias("s")).agg(F.min(_turn()).alias("first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s"))
    marked = equal.join(first, same).withColumn("fresh", F.col("first") == _turn()).drop("c", "s", "said", "first")
    total = equal.agg(F.sum("copies"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-(total[0] or 0) // chunk_rows), -(-(total[1] or 0) // chunk_bytes))
    ranged = written(marked, "long-marked").repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
    schema = T.StructType([*ranged.schema.fields, *T.StructType.fromDDL("chunk long, seq long").fields])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            own = [pa.array([chunk] * n, pa.int64()), pa.array(range(seq, seq + n), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, "chunk", "seq"])
            seq += n

    return written(ranged.mapInArrow(numbered, schema), "long-chunks")


def _turn() -> Column:
    """Turns that order and compare as nulls first."""
    return F.struct(F.col("turn").isNotNull().alias("t"), F.coalesce("turn", F.lit(0)).alias("v"))


_SUMMARY = (
    "chunk long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
    "ways array<struct<q:int,r:int,cost:long,audit:string>>"
)


def _summarise(conv_field: T.StructField):
    """Function of one chunk of one conversation: its counts and its matrix."""
    schema = pa.schema([pa.field("conv", _arrow(conv_field)), *[pa.field(n, t) for n, t in _summary_types()]])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq")
        tally = Tally()
        for role, copies, blank, ended, fresh in zip(*(table.column(n).to_pylist() for n in ("role", "copies", "blank", "ended", "fresh"))):
            for i in range(copies):
                tally.add(role, blank, ended, fresh and not i)
        grammar = Grammar()
        (short,) = grammar.compress([tally.codes])
        matrix = grammar.whole(short)
        ways = [{"q": q, "r": r, "cost": cost, "audit": flat(rope)} for (q, r), (cost, rope) in matrix.items()]
        row = [table.column("conv")[0].as_py(), table.column("chunk")[0].as_py(), tally.blank, tally.duplicate, tally.truncated,
               tally.illegal, tally.first, tally.last, ways]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

    return run


def _arrow(field: T.StructField) -> pa.DataType:
    return to_arrow_type(field.dataType)


def _summary_types() -> list[tuple[str, pa.DataType]]:
    return [(f.name, _arrow(f)) for f in T.StructType.fromDDL(_SUMMARY).fields]


_FOLDED = "chunk long, piece string, blank long, duplicate long, truncated long, illegal long, cost long"


def _fold(conv_field: T.StructField):
    """Function of one conversation's chunk matrices: the audit piece of each
    chunk (the last with the closing insertions), and the totals in the first."""
    names = ["conv", *[f.name for f in T.StructType.fromDDL(_FOLDED).fields]]
    types = [_arrow(conv_field), *[_arrow(f) for f in T.StructType.fromDDL(_FOLDED).fields]]

    def run(table: pa.Table) -> pa.Table:
        chunks = table.sort_by("chunk").to_pylist()
        vector, last, illegal = {START: (0, "")}, None, 0
        for c in chunks:
            matrix = {(w["q"], w["r"]): (w["cost"], w["audit"]) for w in c["ways"]}
            vector = Grammar.step(vector, matrix)
            illegal += c["illegal"] + (last is not None and last + c["head"] not in ("su", "ua", "au"))
            last = c["tail"]
        cost, audit = closed(vector)
        # Rows of each chunk consume as many of the audit's other letters.
        pieces, at = [], 0
        for c in chunks:
            left = sum(map(len, c["ways"][0]["audit"].split("I")))
            start = at
            while left:
                left -= audit[at] != "I"
                at += 1
            pieces.append(audit[start:at])
        pieces[-1] += audit[at:]
        totals = [sum(c[k] for c in chunks) for k in ("blank", "duplicate", "truncated")] + [illegal, cost]
        rows = [(c["conv"], c["chunk"], piece, *(totals if not i else [0] * 5)) for i, (c, piece) in enumerate(zip(chunks, pieces))]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)

    return run


def _replay_stream(conv_type: pa.DataType, as_rows: bool):
    """Task function over (conv, chunk, seq)-sorted rows, where seq -1 holds
    the chunk's audit piece: digests, or the repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, some, replay, digest, place, letters, at = None, False, Replay(), hashlib.sha256(), 0, "", 0
        for batch in slices(batches):
            out: list[tuple] = []

            def emit(edit: str, role: str, text: str) -> None:
                nonlocal place
                if as_rows:
                    out.append((conv, place, edit, role, text))
                else:
                    digest.update(f"{chr(10) if place else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                place += 1

            def insert() -> None:
                nonlocal at
                while at < len(letters) and letters[at] == "I":
                    emit("I", *replay.insert())
                    at += 1

            for key, seq, role, text, copies in zip(*(batch.column(n).to_pylist() for n in ("conv", "seq", "role", "text", "copies"))):
                if some and key != conv:
                    if not as_rows:
                        out.append((conv, digest.hexdigest()))
                    replay, digest, place = Replay(), hashlib.sha256(), 0
                conv, some = key, True
                if seq < 0:
                    letters, at = text, 0
                    insert()
                    continue
                for _ in range(copies):
                    kept = replay.edit(letters[at], role, text)
                    edit, at = letters[at], at + 1
                    if kept:
                        emit(edit, *kept)
                    insert()
            yield _rows(out, conv_type, as_rows)
        if some and not as_rows:
            yield _rows([(conv, digest.hexdigest())], conv_type, as_rows)

    return run


def _rows(rows: list[tuple], conv_type: pa.DataType, as_rows: bool) -> pa.RecordBatch:
    names = ["conv", "place", "edit", "role", "text"] if as_rows else ["conv", "repaired_sha256"]
    types = [conv_type, pa.int64(), *[pa.string()] * 3] if as_rows else [conv_type, pa.string()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _repair_long(rows: DataFrame, as_rows: bool, chunk_rows: int, chunk_bytes: int) -> DataFrame:
    """Reports (or repaired rows) of the long conversations."""
    conv_field = rows.schema["conv"]
    chunked = _with_chunks(rows, chunk_rows, chunk_bytes)
    narrow = chunked.select("conv", "chunk", "seq", F.substring("role", 1, 1).alias("role"), "copies", "blank", "ended", "fresh")
    summary = T.StructType([conv_field, *T.StructType.fromDDL(_SUMMARY).fields])
    folded = T.StructType([conv_field, *T.StructType.fromDDL(_FOLDED).fields])
    chunks = narrow.groupBy("conv", "chunk").applyInArrow(_summarise(conv_field), summary)
    pieces = written(chunks.groupBy("conv").applyInArrow(_fold(conv_field), folded), "long-pieces")
    seq = F.lit(-1).cast("long").alias("seq")
    one = F.lit(1).cast("long").alias("copies")
    stream = chunked.select("conv", "chunk", "seq", "role", "text", "copies").unionByName(
        pieces.select("conv", "chunk", seq, F.lit("").alias("role"), F.col("piece").alias("text"), one)
    )
    sorted_ = stream.repartition("conv").sortWithinPartitions("conv", "chunk", "seq")
    if as_rows:
        schema = T.StructType([conv_field, *T.StructType.fromDDL(_ROWS).fields])
        return sorted_.mapInArrow(_replay_stream(_arrow(conv_field), True), schema)
    schema = T.StructType([conv_field, T.StructField("repaired_sha256", T.StringType())])
    digests = sorted_.mapInArrow(_replay_stream(_arrow(conv_field), False), schema)
    sums = [F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "piece"))), lambda p: p["piece"]), "")
    totals = pieces.groupBy("conv").agg(*sums, audit.alias("audit"))
    turns = chunked.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    out = totals.alias("p").join(turns.alias("t"), F.col("p.conv").eqNullSafe(F.col("t.conv")))
    out = out.join(digests.alias("d"), F.col("p.conv").eqNullSafe(F.col("d.conv")))
    return out.select(F.col("p.conv").alias("conv"), *[f.name for f in T.StructType.fromDDL(_REPORT).fields])


def _nothing(field: T.StructField) -> Column:
    """The column of a row that only names its conversation."""
    value = {"turn": None, "copies": 0, "blank": True, "ended": False}.get(field.name, "")
    return F.lit(value).cast(field.dataType).alias(field.name)


# --- the operator -----------------------------------------------------------------


def _run(rows: DataFrame, as_rows: bool, most_rows: int, most_bytes: int) -> DataFrame:
    dropped = rows.where("copies = 0").select("conv").distinct()
    rows = rows.where("copies > 0")
    long = long_conversations(rows, most_rows, most_bytes)
    schema = T.StructType([rows.schema["conv"], *T.StructType.fromDDL(_ROWS if as_rows else _REPORT).fields])
    arrow = pa.schema([pa.field(f.name, _arrow(f)) for f in schema.fields])
    some_long = not long.isEmpty()
    theirs = long.select(F.col("conv").alias("long"))
    is_long = F.col("conv").eqNullSafe(F.col("long"))
    # A conversation that lost rows is named once, also if none is left.
    short = rows.unionByName(dropped.select(*[F.col("conv") if f.name == "conv" else _nothing(f) for f in rows.schema.fields]))
    short = short.join(theirs, is_long, "left_anti") if some_long else short
    dealt = short.repartition("conv").sortWithinPartitions(*_order())
    out = dealt.mapInArrow(_task(Turns if as_rows else Reports, arrow), schema)
    if some_long:
        out = out.unionByName(_repair_long(rows.join(theirs, is_long, "left_semi"), as_rows, most_rows, most_bytes))
    return out


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None, most_rows: int = LONG_ROWS, most_bytes: int = LONG_BYTES,
) -> DataFrame:
    """One report for each conversation of ``rows``: ``conv_col, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``.  A row
    stands for ``copies_col`` equal rows; with 0 it only names its
    conversation."""
    ready = prepared(rows, conv_col, turn_col, role_col, text_col, copies_col)
    return _run(ready, False, most_rows, most_bytes).withColumnRenamed("conv", conv_col)


def repaired_rows(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copies_col: str | None = None, most_rows: int = LONG_ROWS, most_bytes: int = LONG_BYTES,
) -> DataFrame:
    """The repaired conversations themselves: ``conv_col, place, edit, role,
    text`` with the place in the conversation from 0 and the edit's initial."""
    ready = prepared(rows, conv_col, turn_col, role_col, text_col, copies_col)
    return _run(ready, True, most_rows, most_bytes).withColumnRenamed("conv", conv_col)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies``: the task's damage, by crc32 of
    ``conv_id:turn`` modulo 20 (nulls are one space).  A dropped row stays
    with 0 copies, so that its conversation is known."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind <= 1, F.lit("")).when(kind == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(spaced("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
