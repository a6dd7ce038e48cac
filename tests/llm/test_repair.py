import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from camlytics.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        fate = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def faults(rows):
    """blank, duplicate, truncated or None for each row."""
    out, seen = [], set()
    for role, text in rows:
        solid = SPACE.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Least cost, then least string, over a table of rows and states, with the repaired turns."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    n = len(rows)
    best = {}
    for i in range(n, -1, -1):
        # Two rounds: a turn put in leads to another state of the same row.
        for _ in range(3):
            for q in after:
                options = [(0, "", ())] if i == n and q in ("", "a") else []
                if (i, after[q]) in best:
                    c, s, t = best[i, after[q]]
                    options.append((c + 3, "I" + s, ((names[after[q]], ""), *t)))
                if i < n:
                    role, text = rows[i]
                    c, s, t = best[i + 1, q]
                    options.append((c + 4, "D" + s, t))
                    if kinds[i] not in ("blank", "duplicate"):
                        extra = 3 * (kinds[i] == "truncated")
                        first = role[:1]
                        if first == after[q] or (first == "s" and q == ""):
                            c, s, t = best[i + 1, first]
                            options.append((c + extra, "K" + s, ((role, text), *t)))
                        c, s, t = best[i + 1, after[q]]
                        options.append((c + 3 + extra, "R" + s, ((names[after[q]], text), *t)))
                if options:
                    best[i, q] = min(options, key=lambda o: o[:2])
    return best[0, ""]


def by_trying(rows, kinds):
    """Least cost and string, over every sequence of edits of a few rows."""
    found = None
    for edits in itertools.product("DKua", repeat=len(rows)):
        for put in itertools.product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            roles, letters, cost = "", "", 0
            for i, p in enumerate(put):
                roles, letters, cost = roles + p, letters + "I" * len(p), cost + 3 * len(p)
                if i == len(rows):
                    break
                e = edits[i]
                if e != "D" and kinds[i] in ("blank", "duplicate"):
                    cost += 10**6
                letters += e if e in "DK" else "R"
                cost += 4 if e == "D" else (3 if e in "ua" else 0) + 3 * (kinds[i] == "truncated")
                roles += "" if e == "D" else (rows[i][0][:1] or "?") if e == "K" else e
            if re.fullmatch(repair.ROLES, roles) and (found is None or (cost, letters) < found):
                found = (cost, letters)
    return found


def plain(original, rows):
    """The query's result, from rows after damage."""
    out = []
    for conv in {r[0] for r in original}:
        some = sorted(([t, " " if r is None else r, " " if x is None else x] for c, t, r, x in rows if c == conv), key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))
        pairs = [(r, x) for _, r, x in some]
        kinds = faults(pairs)
        turns = {t for t, *_ in some if t is not None}
        cost, letters, turned = cheapest(pairs, kinds)
        firsts = [r[:1] for r, _ in pairs]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
            cost, letters, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turned).encode()).hexdigest(),
        ))
    return out


def as_set(rows):
    return sorted(map(tuple, rows), key=repr)


def test_the_table_is_right_for_few_rows():
    rnd = random.Random(2)
    for _ in range(60):
        rows = [(rnd.choice(["system", "user", "assistant", "tool", "u2"]), rnd.choice(["a.", "b", " ", "c?"])) for _ in range(rnd.randint(0, 3))]
        kinds = faults(rows)
        assert cheapest(rows, kinds)[:2] == by_trying(rows, kinds)


def test_query_like_plain_python(spark, tiny):
    got = queries.op11_conversation_repair(spark, tiny)
    rows = [tuple(r) for r in spark.read.parquet(f"{tiny}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_set(got.collect()) == as_set(plain(rows, damage(rows)))
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == [
        "conv_id bigint", *[f"{c} bigint" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        "audit string", "repaired_sha256 string",
    ]


def conversation(rnd, conv, size, roles, texts):
    return [(conv, t if rnd.random() < 0.95 else None, rnd.choice(roles), rnd.choice(texts)) for t in range(size)]


@pytest.mark.parametrize("span,fixups", [(2, 4), (3, 0), (64, 4)])
def test_any_chunks(spark, span, fixups):
    rnd = random.Random(span)
    kinds = [["user", "assistant"], ["system", "user", "assistant", "tool"], ["tool"], ["user"], ["assistant", "assistant", "user", "", "s"]]
    rows = []
    for conv in range(30):
        texts = [f"t{i}{rnd.choice(['.', '!', '', ' ?  '])}" for i in range(rnd.choice([1, 2, 99]))] + [" "]
        rows += conversation(rnd, conv, rnd.randint(1, 24), kinds[conv % 5], texts)
    # Long stretches in which no chunk settles the costs after it.
    rows += [(100, i, "tool", f"x{i}.") for i in range(41)] + [(101, i, "user", "same.") for i in range(40)] + [(101, 40, "assistant", "end.")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = repair.audit(docs, span=span, fixups=fixups)
    assert as_set(got.collect()) == as_set(plain(rows, rows))


def test_repaired_turns(spark):
    rows = [(7, 3, "user", "How?"), (7, 1, "system", "Be kind."), (7, 2, "user", "Hello."), (8, 1, "assistant", ""), (7, 4, "assistant", "So.")]
    got = [tuple(r) for r in repair.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "place", "step").collect()]
    # Deleting costs 4, an answer put in 3.
    assert [(r[0], r[3], *r[4:]) for r in got] == [
        (7, "K", 1, "system", "Be kind."), (7, "K", 2, "user", "Hello."), (7, "I", None, "assistant", ""),
        (7, "K", 3, "user", "How?"), (7, "K", 4, "assistant", "So."),
    ]


def test_odd_and_empty_tables(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "a b."), (1, None, "user", "x."), (1, None, "user", "x."), (1, 2**40, "", "ends. \x0b"),
        (2, 1, "user", "y" * 200_000), (2, 1, "assistant", "é \U0001F600!"), (3, 5, "user", "\x1c"), (4, 1, "user", "\t\n"), (None, 1, "user", "a b."),
    ] + [(5, 1, "user", "again.")] * 50
    clashing = spark.createDataFrame([(*r, 1, "k", 2, "w") for r in rows], SCHEMA + ", _rank int, _conv string, n int, audit string")
    assert as_set(repair.audit(clashing).collect()) == as_set(plain(rows, rows))
    assert as_set(repair.audit(repair.damaged(clashing), among=clashing).collect()) == as_set(plain(rows, damage(rows)))
    none = clashing.where(F.lit(False))
    assert repair.audit(repair.damaged(none), among=none).count() == 0 and repair.repaired(none).count() == 0


def test_nothing_left(spark):
    got = repair.audit(spark.createDataFrame([], SCHEMA), among=spark.createDataFrame([(1,), (None,)], "conv_id long")).collect()
    assert as_set(got) == as_set([(i, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for i in (1, None)])
