import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from riskspark.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(data):
    out = defaultdict(list)
    for conv, turn, role, text in data:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]  # every conversation has a row
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        found.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def forward(rows, found):
    """Smallest (cost, audit) for each legal prefix: a search from the front."""
    accept = {"": "0", "s": "S", "u": "U", "a": "A"}
    follow = {"0": "su", "S": "u", "U": "a", "A": "u"}
    best = {"0": (0, "", ())}

    def better(to, cost, audit, made, where):
        if to not in where or (cost, audit) < where[to][:2]:
            where[to] = (cost, audit, made)
            return True
        return False

    def inserted(where):
        again = True
        while again:
            again = False
            for state, (cost, audit, made) in list(where.items()):
                for role in ("user", "assistant"):
                    if role[0] in follow[state]:
                        again |= better(accept[role[0]], cost + 2, audit + "I", (*made, f"{role}:"), where)
        return where

    for (_, role, text), fault in zip(rows, found, strict=True):
        after = {}
        for state, (cost, audit, made) in inserted(best).items():
            better(state, cost + 3, audit + "D", made, after)
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if role[:1] and role[0] in follow[state]:
                better(accept[role[0]], cost + extra, audit + "K", (*made, f"{role}:{text}"), after)
            for other in ("user", "assistant"):
                if other[0] in follow[state]:
                    better(accept[other[0]], cost + 2 + extra, audit + "R", (*made, f"{other}:{text}"), after)
        best = after
    return min(v for k, v in inserted(best).items() if k in "0A")


def everything(rows, found, most):
    """All edit sequences with at most ``most`` insertions at each place."""
    inserts = [seq for n in range(most + 1) for seq in product(("user", "assistant"), repeat=n)]
    options = []
    for (_, role, text), fault in zip(rows, found, strict=True):
        extra = fault == "truncated"
        own = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            own += [(extra, "K", f"{role}:{text}"), *[(2 + extra, "R", f"{x}:{text}") for x in ("user", "assistant")]]
        options += [[(2 * len(s), "I" * len(s), [f"{x}:" for x in s]) for s in inserts], own]
    options.append([(2 * len(s), "I" * len(s), [f"{x}:" for x in s]) for s in inserts])
    best = None
    for choice in product(*options):
        made = [y for _, _, x in choice if x is not None for y in (x if isinstance(x, list) else [x])]
        if re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in made)):
            here = (sum(c for c, _, _ in choice), "".join(a for _, a, _ in choice), tuple(made))
            best = here if best is None or here[:2] < best[:2] else best
    return best


def expected(data, search=forward):
    out = []
    for conv, rows in damage(data).items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        found = faults(rows)
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1], b[1][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in zip(rows, rows[1:], strict=False))
        cost, audit, made = search(rows, found)
        out.append((conv, gaps, *[found.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, **how):
    return sorted((tuple(r) for r in C.summary(C.repair(C.damaged(df), times_col="times", **how)).select(*COLUMNS).collect()), key=str)


def talk(seed, convs, turns, roles=("user", "assistant", "user", "assistant", "system", "tool", "")):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", "Go on. ", "é!\n", "So it is", None]
    out = []
    for c in range(convs):
        for t in range(rng.randrange(turns + 1)):
            out.append((c, t * rng.choice((1, 1, 1, 2)), rng.choice(roles), rng.choice([*texts, *[f"text {c} {t}."] * 9])))
    return out


def test_search_from_the_front_is_least_of_all():
    for seed in range(6):
        data = [r for r in talk(seed, 12, 3)]
        assert expected(data) == expected(data, lambda rows, found: everything(rows, found, 2))


@pytest.mark.parametrize("most_rows", [1, 2, 5, 4096])
def test_random_conversations(spark, most_rows):
    data = talk(most_rows, 60, 9)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    assert got(df, most_rows=most_rows) == expected(data)


def test_one_conversation_over_many_pieces(spark):
    """Mixed rows converge at once; rows of one role only never do, so that all
    passes are needed; rows that must all go pass the costs through."""
    mixed = [(1, t, "user assistant".split()[t % 2 if t % 7 else 0], f"t{t}.") for t in range(400)]
    users = [(2, t, "user", f"t{t}.") for t in range(301)]
    blank = [(3, t, "user", " ") for t in range(120)] + [(3, 120, "assistant", "x")]
    system = [(4, t, "system", f"t{t}") for t in range(50)]
    same = [(5, t, "assistant", "Same.") for t in range(90)]
    data = mixed + users + blank + system + same
    df = spark.createDataFrame(data, SCHEMA)
    assert got(df, most_rows=7) == expected(data)
    assert got(df, most_rows=3, most_chars=10) == expected(data)


def test_passes_double(spark, monkeypatch):
    seen = []
    real = C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df: seen.append(1) or real(df))
    users = [(2, t, "user", f"t{t}.") for t in range(1024)]
    C.summary(C.repair(spark.createDataFrame(users, SCHEMA), most_rows=4)).count()
    assert len(seen) < 40  # 256 pieces: at most 9 passes each way, not 256


def test_awkward_rows(spark):
    data = [(None, None, None, None), (None, 3, "user", "a."), (None, 4, "assistant", "b."), (1, None, "user", None), (1, None, None, "x"), (2, 5, "user", "q?")] * 2
    data += [(3, 0, "system", "s."), (3, 0, "system", "s."), (3, 0, "assistant", "a!"), (3, 9, "user", "u"), (4, 0, "user", "word " * 400_000 + "."), (4, 1, "assistant", "ok.")]
    data += [(c, t, "user", "u.") for c in range(10, 60) for t in range(2)]  # some lose every row
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    want = expected(data)
    assert any(r[-1] == hashlib.sha256(b"").hexdigest() and not r[7] for r in want)
    assert got(df) == want
    assert got(df, most_rows=2) == want
    assert got(df.withColumn("g", F.lit(1)).withColumn("whole", F.lit("x")).withColumn("spec", F.lit(None))) == want


def test_empty_table_and_repeats(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    many = spark.createDataFrame([(1, 0, "user", "a.", 3), (1, 1, "assistant", "b.", 1_000_000), (2, 0, "user", "a.", 0)], SCHEMA + ", n int")
    a, b = C.summary(C.repair(many, times_col="n")).orderBy("conv_id").collect()
    assert (a.audit, a.duplicate, a.illegal, a.cost) == ("KDDK" + "D" * 999_999, 1_000_001, 1_000_001, 3 * 1_000_001)
    assert (b.audit, b.cost, b.gaps, b.turns) == ("", 0, 0, 0)


def test_repaired_turns_are_real(spark):
    data = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Are you there?")]
    turns = [x for r in C.repair(spark.createDataFrame(data, SCHEMA)).orderBy("g").collect() for x in r.repaired]
    assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in turns)) and "Are you there?" in [x.text for x in turns]
