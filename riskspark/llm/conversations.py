"""Conversation repair: cheapest edits by a rank-convergence parallel Viterbi.

Rows of a conversation stand in order of turn (NULL first), then role, then
text.  The cheapest edits that make the roles' initials ``(s?(ua)+)?`` come from
a Viterbi search over four states: nothing yet (0), after a system row (S),
after a user row (U), after an assistant row (A).  0 and A may end.

1. Rows are dealt to ranges of the full order, so a conversation with a third
   of all rows spreads over many tasks, and cut into *pieces* of one conversation.
   A conversation that lies in one piece is repaired on the spot.
2. A piece of a split conversation does not know the backward costs after its
   end.  It runs backward from four speculative cost vectors, which bound all
   true ones (``SPECULATIVE``), and so gets four vectors at its start.
3. Fix-up passes run again from the vectors of the piece behind, twice as far
   each time, until a piece's four vectors differ only by constants, or its
   conversation ends.  Then the costs at its start are known up to a constant,
   which no decision depends on.  A pass is a join on the piece's number.
4. With the stitched costs each piece traces the ASCII-least cheapest edits from
   every entering state; the same passes put the leaving states together.

Repeated rows are added up before they are dealt, and whether a row was seen
earlier is a partially aggregated minimum joined back, so no group is gathered.
Only the digest of a split conversation needs its pieces in one sequence; they
are streamed.

Defined cases: NULL roles and texts are one space, NULL conversation ids are one
conversation; an empty role has no initial and can't be kept; roles are told by
their first character, as it stands.  Equal rows of one turn count as repeats.
An empty table has no rows.  A very long text is a piece of its own.  Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskspark.operators.modeltables import keep
from riskspark.session import cut_lineage
from riskspark.sources.tables import table

from .catalog import query

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

#: Rows and characters of a piece.
PIECE_ROWS = 4096
PIECE_CHARS = 1 << 20

_SPACE = " \t\n\x0b\x0c\r"
_STOPS = (".", "!", "?")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

# States in the order 0, S, U, A.  What an inserted or rerolled row leads to:
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
_KEPT = {("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3, ("s", 0): 1}

#: Backward costs at the end of a conversation: S lacks two rows, U one.
AT_END = [0, 2 * INSERT, INSERT, 0]


def _speculative() -> list[list[int]]:
    """bound[k][j]: the most that state k can cost above state j before any
    rows.  One insertion leads from 0, S and A to U and from U to A; what S can
    do A can do, what A can do 0 can do; and A catches up with 0 by deleting the
    system row."""
    bound = [[0 if k == j else 99 for j in range(4)] for k in range(4)]
    for k, j, most in [(0, 2, INSERT), (1, 2, INSERT), (3, 2, INSERT), (2, 3, INSERT), (3, 1, 0), (0, 3, 0), (3, 0, DELETE)]:
        bound[k][j] = most
    for via, k, j in product(range(4), repeat=3):
        bound[k][j] = min(bound[k][j], bound[k][via] + bound[via][j])
    return bound


#: Column j is the cost vector a piece starts from for state j.
SPECULATIVE = _speculative()


def _before(after: list[int], initial: str, extra: int) -> list[int]:
    """Backward costs before a row that need not be deleted, insertions included."""
    o, s, u, a = after
    to_u = u + extra + (0 if initial == "u" else REROLE)
    to_a = a + extra + (0 if initial == "a" else REROLE)
    o2, s2, u2, a2 = min(to_u, DELETE + o), min(to_u, DELETE + s), min(to_a, DELETE + u), min(to_u, DELETE + a)
    if initial == "s":
        o2 = min(o2, extra + s)
    u3, a3 = min(u2, INSERT + a2), min(a2, INSERT + u2)
    return [min(o2, INSERT + u3), min(s2, INSERT + u3), u3, a3]


class _Rows:
    """Rows of one piece: (role, text, times, again)."""

    def __init__(self, rows: list[dict]):
        self.rows = rows
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        #: (initial, extra) or None for rows that must go
        self.kinds: list[tuple[str, int] | None] = []
        self.first = self.last = None
        for r in rows:
            initial, n, core = r["role"][:1], r["times"], r["text"].rstrip(_SPACE)
            if not core:
                self.blank += n
                self.kinds.append(None)
            elif r["again"]:
                self.duplicate += n
                self.kinds.append(None)
            else:
                cut = not core.endswith(_STOPS)
                self.truncated += cut
                self.duplicate += n - 1
                self.kinds.append((initial, TRUNCATED * cut))
            if self.last is None:
                self.first = initial
            else:
                self.illegal += (self.last, initial) not in _LEGAL
            self.illegal += n - 1
            self.last = initial

    def back(self, after: list[int]) -> list[list[int]]:
        """Costs before each row, and after the last; forced deletions left out."""
        found = [after]
        for kind in reversed(self.kinds):
            found.append(_before(found[-1], *kind) if kind else found[-1])
        return found[::-1]

    def speculate(self) -> list[int]:
        columns = [self.back([row[j] for row in SPECULATIVE])[0] for j in range(4)]
        least = min(map(min, columns))
        return [columns[j][i] - least for i in range(4) for j in range(4)]

    def trace(self, state: int, costs: list[list[int]], ends: bool) -> tuple[int, str, int, list[dict]]:
        """Leaving state, audit, cost and repaired rows of the ASCII-least
        cheapest edits from a state, by the costs that ``back`` has found."""
        audit, cost, made = [], 0, []
        for r, kind, here, after in zip(self.rows, self.kinds, costs, costs[1:], strict=False):
            n = r["times"]
            if kind is None:
                audit.append("D" * n)
                cost += DELETE * n
                continue
            initial, extra = kind
            while True:
                to = _KEPT.get((initial, state))
                if DELETE + after[state] == here[state]:
                    audit.append("D")
                    cost += DELETE
                elif INSERT + here[_NEXT[state]] == here[state]:
                    audit.append("I")
                    cost += INSERT
                    made.append({"role": _ROLE[state], "text": ""})
                    state = _NEXT[state]
                    continue
                elif to is not None and extra + after[to] == here[state]:
                    audit.append("K")
                    cost += extra
                    made.append({"role": r["role"], "text": r["text"]})
                    state = to
                else:
                    audit.append("R")
                    cost += REROLE + extra
                    made.append({"role": _ROLE[state], "text": r["text"]})
                    state = _NEXT[state]
                break
            audit.append("D" * (n - 1))
            cost += DELETE * (n - 1)
        while ends and AT_END[state]:
            audit.append("I")
            cost += INSERT
            made.append({"role": _ROLE[state], "text": ""})
            state = _NEXT[state]
        return state, "".join(audit), cost, made


_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_FIELDS = "part int, seq long, whole boolean, low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string, cost long, audit string"


def _piece_schema(conv: T.DataType) -> T.StructType:
    rows = T.ArrayType(T.StructType.fromDDL("role string, text string, times long, again boolean"))
    return T.StructType(
        [T.StructField("conv_id", conv), *T.StructType.fromDDL(_FIELDS).fields, T.StructField("repaired", _TURNS), T.StructField("rows", rows), T.StructField("spec", T.ArrayType(T.LongType()))]
    )


def _counted(x: _Rows) -> dict:
    return {"blank": x.blank, "duplicate": x.duplicate, "truncated": x.truncated, "illegal": x.illegal, "first_role": x.first, "last_role": x.last}


def _cutter(schema: pa.Schema, most_rows: int, most_chars: int):
    """Sorted rows of one range -> its pieces, in order."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        out: list[dict] = []
        held: list[dict] = []  # rows of the open piece
        chars = pieces = 0  # of it; pieces that its conversation has had here
        conv, convs = None, 0

        def close(ended: bool) -> None:
            nonlocal seq, pieces, held, chars
            x = _Rows([r for r in held if r["times"]])
            turns = [r["turn"] for r in held if r["times"] and r["turn"] is not None]
            row = {"conv_id": conv, "part": part, "seq": seq, "low": min(turns, default=None), "high": max(turns, default=None), "distinct": len(set(turns)), **_counted(x)}
            # the first and the last conversation of a range may go on in others
            if ended and convs > 1 and not pieces:
                _, audit, cost, made = x.trace(0, x.back(AT_END), True)
                row |= {"whole": True, "audit": audit, "cost": cost, "repaired": made}
            else:
                row |= {"whole": False, "rows": x.rows, "spec": x.speculate()}
            out.append(row)
            seq, pieces, held, chars = seq + 1, pieces + 1, [], 0

        for batch in batches:
            for r in batch.to_pylist():
                if not convs or r["conv_id"] != conv:
                    if convs:
                        close(True)
                    conv, convs, pieces = r["conv_id"], convs + 1, 0
                elif held and (len(held) >= most_rows or chars + len(r["text"]) > most_chars):
                    close(False)
                held.append(r)
                chars += len(r["text"])
                if len(out) >= 512:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if convs:
            close(False)
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


# -- passes over the pieces of split conversations ------------------------------


def _times(a: Column, b: Column) -> Column:
    """Costs of one piece followed by another, less their smallest."""
    raw = F.array(*[F.least(*[a[4 * i + k] + b[4 * k + j] for k in range(4)]) for i in range(4) for j in range(4)])
    return F.transform(raw, lambda x: x - F.array_min(raw))


def _parallel(m: Column) -> Column:
    """The four vectors differ only by constants."""
    same = F.lit(True)
    for i, j in product(range(1, 4), repeat=2):
        same &= m[4 * i + j] - m[j] == m[4 * i] - m[0]
    return same


def _put_together(state: DataFrame, joined, settled) -> DataFrame:
    """Passes over (g, to, m, done): an open piece takes in the one at ``to``
    with all that it covers, until ``settled``.  The covered length doubles, so
    there are as many passes as the longest conversation's pieces have binary
    digits."""
    state = cut_lineage(state)
    while not state.filter("not done").isEmpty():
        other = state.select(F.col("g").alias("to"), F.col("m").alias("m2"), F.col("to").alias("to2"), F.col("done").alias("done2"))
        new = F.when(F.col("done"), F.col("m")).otherwise(joined(F.col("m"), F.col("m2")))
        both = state.join(other, "to", "left").select("g", F.when(F.col("done"), F.col("to")).otherwise(F.col("to2")).alias("to"), new.alias("m"), "done", "done2")
        state = cut_lineage(both.select("g", "to", "m", (F.col("done") | F.col("done2") | settled(F.col("m"))).alias("done")))
    return state


def _stitched(split: DataFrame) -> DataFrame:
    """(g, after): backward costs behind each piece, up to a constant."""
    end = F.array(*[F.lit(AT_END[k]).cast("long") for k in range(4) for _ in range(4)])
    m = F.when(F.col("ends"), _times(F.col("spec"), end)).otherwise(F.col("spec"))
    first = split.select("g", F.when(~F.col("ends"), F.col("g") + 1).alias("to"), m.alias("m"), (F.col("ends") | _parallel(F.col("spec"))).alias("done"))
    known = _put_together(first, _times, _parallel)
    before = known.select((F.col("g") - 1).alias("g"), F.array(*[F.col("m")[4 * i] for i in range(4)]).alias("after"))
    at_end = F.array(*[F.lit(x).cast("long") for x in AT_END])
    return split.select("g", "ends").join(before, "g", "left").select("g", F.when(F.col("ends"), at_end).otherwise(F.col("after")).alias("after"))


def _entered(exits: DataFrame) -> DataFrame:
    """(g, entry): the state in which each piece is entered."""

    def chained(m: Column, earlier: Column) -> Column:
        return F.transform(earlier, lambda x: F.element_at(m, (x + 1).cast("int")))

    def constant(m: Column) -> Column:
        return F.array_min(m) == F.array_max(m)

    m = F.when(F.col("begins"), F.array_repeat(F.col("exits")[0], 4)).otherwise(F.col("exits"))
    first = exits.select("g", F.when(~F.col("begins"), F.col("g") - 1).alias("to"), m.alias("m"))
    known = _put_together(first.withColumn("done", F.col("to").isNull() | constant(F.col("m"))), chained, constant)
    left = known.select((F.col("g") + 1).alias("g"), F.col("m")[0].alias("entry"))
    return exits.select("g", "begins").join(left, "g", "left").select("g", F.when(F.col("begins"), 0).otherwise(F.col("entry")).alias("entry"))


def _leave(batches):
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            x = _Rows(r["rows"])
            costs = x.back(r["after"])
            found.append({"g": r["g"], "begins": r["begins"], "exits": [x.trace(s, costs, r["ends"])[0] for s in range(4)]})
        yield pa.RecordBatch.from_pylist(found, pa.schema([("g", pa.int64()), ("begins", pa.bool_()), ("exits", pa.list_(pa.int64()))]))


def _tracer(schema: pa.Schema):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                x = _Rows(r["rows"])
                _, audit, cost, made = x.trace(r["entry"], x.back(r["after"]), r["ends"])
                yield pa.RecordBatch.from_pylist([{k: r[k] for k in schema.names if k in r} | {"audit": audit, "cost": cost, "repaired": made, "rows": None, "spec": None}], schema)

    return run


def _pieces(df: DataFrame, most_rows: int, most_chars: int) -> DataFrame:
    """Pieces of all conversations, written to the shared folder."""
    rows = df.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    key = [F.col("conv_id"), F.col("role"), F.md5(F.col("text").cast("binary")).alias("digest")]
    seen = rows.filter("times > 0").groupBy(*key).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    seen = seen.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), F.col("first.turn").alias("_turn"), F.lit(True).alias("_found"))
    rows = rows.withColumn("digest", key[2]).join(seen, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")), "left")
    later = F.col("turn").isNotNull() & (F.col("_turn").isNull() | (F.col("turn") > F.col("_turn")))
    rows = rows.select("conv_id", "turn", "role", "text", "times", F.coalesce(F.col("_found") & later, F.lit(False)).alias("again"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, "conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = _piece_schema(df.schema["conv_id"].dataType)
    return keep(dealt.mapInArrow(_cutter(to_arrow_schema(schema), most_rows, most_chars), schema))


def repair(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None, most_rows: int = PIECE_ROWS, most_chars: int = PIECE_CHARS
) -> DataFrame:
    """Pieces of repaired conversations: conv_id, g (order of the pieces of a
    conversation), its counts, cost, audit and ``repaired``, an array of (role,
    text).  ``times_col`` says how often a row stands there; 0 only names its
    conversation."""
    times = F.coalesce(F.col(f"`{times_col}`"), F.lit(0)).cast("long") if times_col else F.lit(1).cast("long")
    there = times > 0
    plain = df.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.when(there, F.col(f"`{turn_col}`").cast("long")).alias("turn"),
        F.when(there, F.coalesce(F.col(f"`{role_col}`"), F.lit(" "))).otherwise("").alias("role"),
        F.when(there, F.coalesce(F.col(f"`{text_col}`"), F.lit(" "))).otherwise("").alias("text"),
        times.alias("times"),
    )
    spark = df.sparkSession
    pieces = _pieces(plain, most_rows, most_chars)
    counts = {r.part: r.n for r in pieces.groupBy("part").agg(F.count("*").alias("n")).collect()}  # a number for each range
    offsets, at = [], 0
    for part in sorted(counts):
        offsets.append((part, at))
        at += counts[part]
    placed = pieces.join(F.broadcast(spark.createDataFrame(offsets, "part int, offset long")), "part").withColumn("g", F.col("offset") + F.col("seq")).drop("offset")
    # with the names of pieces.columns and g
    cols = [*pieces.columns, "g"]
    whole, split = placed.filter("whole").select(*cols), placed.filter("not whole").select(*cols)
    narrow = split.select("conv_id", "g", "spec")

    def beside(step: int, name: str) -> DataFrame:
        return narrow.select((F.col("g") - step).alias("g"), F.struct("conv_id").alias(name))

    own = F.struct("conv_id")
    edges = narrow.join(beside(1, "behind"), "g", "left").join(beside(-1, "ahead"), "g", "left")
    edges = cut_lineage(
        edges.select("g", "spec", (~own.eqNullSafe(F.col("behind"))).alias("ends"), (~own.eqNullSafe(F.col("ahead"))).alias("begins"))
    )
    costs = cut_lineage(_stitched(edges).join(edges.select("g", "ends", "begins"), "g"))
    known = split.join(costs, "g")
    exits = cut_lineage(known.select("g", "rows", "after", "ends", "begins").mapInArrow(_leave, "g long, begins boolean, exits array<long>"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("g", T.LongType())])
    traced = known.join(_entered(exits), "g").mapInArrow(_tracer(to_arrow_schema(schema)), schema)
    return whole.unionByName(traced).drop("rows", "spec", "part", "seq")


_LINE = "concat_ws('\\n', transform(repaired, x -> concat(x.role, ':', x.text)))"


def _assembler(schema: pa.Schema):
    """Pieces in the order of (conv_id, g) -> a row per conversation; streamed."""

    def run(batches):
        row = digest = high = last = None
        audit: list[str] = []

        def done() -> pa.RecordBatch:
            row["gaps"] = row["high"] - row["low"] + 1 - row["distinct"] if row["low"] is not None else 0
            row["audit"], row["repaired_sha256"] = "".join(audit), digest.hexdigest()
            return pa.RecordBatch.from_pylist([{k: row[k] for k in schema.names}], schema)

        for batch in batches:
            for r in batch.to_pylist():
                if row is None or r["conv_id"] != row["conv_id"]:
                    if row is not None:
                        yield done()
                    row = r | {"turns": 0}
                    digest, audit, high, last = hashlib.sha256(), [], r["high"], r["last_role"]
                else:
                    for k in ("blank", "duplicate", "truncated", "illegal", "cost", "distinct"):
                        row[k] += r[k]
                    if r["low"] is not None:
                        row["distinct"] -= r["low"] == high
                        row["low"] = r["low"] if row["low"] is None else row["low"]
                        row["high"] = high = r["high"]
                    if r["first_role"] is not None:
                        row["illegal"] += last is not None and (last, r["first_role"]) not in _LEGAL
                        last = r["last_role"]
                audit.append(r["audit"])
                for x in r["repaired"]:
                    digest.update(f"{chr(10) if row['turns'] else ''}{x['role']}:{x['text']}".encode())
                    row["turns"] += 1
        if row is not None:
            yield done()

    return run


def summary(pieces: DataFrame) -> DataFrame:
    """One row per conversation: gaps, counts, cost, audit, the number of
    repaired rows and the SHA-256 of the lines ``role:text``."""
    conv = pieces.schema["conv_id"]
    schema = T.StructType([conv, *T.StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns long, repaired_sha256 string").fields])
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0)).cast("long")
    made = {"gaps": gaps, "turns": F.size("repaired").cast("long"), "repaired_sha256": F.sha2(F.expr(_LINE).cast("binary"), 256)}
    whole = pieces.filter("whole").select(*[made.get(f.name, F.col(f.name)).alias(f.name) for f in schema.fields])
    split = pieces.filter("not whole").drop("whole")
    dealt = split.repartition("conv_id").sortWithinPartitions("conv_id", "g")
    return whole.unionByName(dealt.mapInArrow(_assembler(to_arrow_schema(schema)), schema))


def damaged(df: DataFrame) -> DataFrame:
    """conversations with the damage that ``crc32(conv_id:turn) % 20`` calls
    for, and ``times``: 0 for a dropped row, 2 for a repeated one."""

    def written(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(written("conv_id"), F.lit(":"), written("turn")).cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return df.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    found = summary(repair(damaged(table(spark, sf_dir, "conversations")), times_col="times"))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "turns")
