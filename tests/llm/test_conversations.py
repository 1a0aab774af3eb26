"""Chat formatting, whitening and conversation repair against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import chat_format, conversation_repair, whitening

SCHEMA = "conv_id long, turn long, role string, text string, segments string, audit string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def talks():
    rnd = random.Random(4)
    signs = ["", " ", "Hi.", "So?", "no end", "\\", "\\-", "<turn>", "</turn>", "### ", "#### User: x", "<<turn>", "a ",
             "ü.", "\\### Assistant: </turn> ok", "end.\n\t ", "x" * 30_000 + ".", None]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rnd.randint(1, 9)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool: ", None, "User"]) if rnd.random() < 0.4 \
                else ("user", "assistant")[turn % 2]
            rows.append((conv, turn if rnd.random() < 0.95 else None, role, rnd.choice(signs) if rnd.random() < 0.5 else f"t{rnd.random()}."))
    rows += rows[:7] + [(100, 5, "user", "late."), (100, 9, "assistant", "gap."), (100, 9, "assistant", "another at 9")]
    rows += [(200, t, ("user", "assistant")[t % 2], f"turn {t}{'.' * (t % 5 > 0)}") for t in range(3000)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, talks):
    return spark.createDataFrame([(*r, "s", "a") for r in talks], SCHEMA).repartition(3)


def by_conv(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def test_chat_format(spark, frame, talks):
    turns = chat_format.format_turns(frame)
    got = {r.conv_id: r for r in chat_format.conversations_read(chat_format.read_back(turns)).collect()}
    first = lambda x: (x is not None, x)
    for conv, rows in by_conv(talks).items():
        rows = sorted(((r[1], r[2] or "", r[3] or "") for r in rows), key=lambda r: (first(r[0]), r[1].encode(), r[2].encode()))
        codes = "".join({"system": "s", "user": "u", "assistant": "a"}.get(r[1], "x") for r in rows)
        good = max(k for k in range(len(codes) + 1) if any((p + "ua" * 2000).startswith(codes[:k]) for p in ("", "s")))
        loss = "".join(t for _, role, t in rows if role == "assistant")
        want = (len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(loss), sha(loss),
                bool(codes) and codes in ("ua" * (len(codes) // 2), "s" + "ua" * (len(codes) // 2)) and codes != "s",
                -1 if good == len(codes) else good)
        g = got[conv]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256, g.valid, g.bad_turn) == want, conv
    assert len(got) == len(by_conv(talks))
    # a whole conversation splits at the unescaped control strings alone
    for r in turns.select(chat_format.formatted().alias("f"), "segments").collect():
        assert r.f.count("<turn>") == 1 and r.f.count("</turn>") == 1 and r.f.count("### ") == 1
        assert "".join(s.text for s in r.segments) == r.f and r.f.endswith("</turn>\n")
    total = dict(turns.groupBy("conv_id").agg(F.sum(F.length(chat_format.formatted()))).collect())
    assert total == {k: g.formatted_chars for k, g in got.items()}


def test_chat_format_of_nothing(spark, frame):
    assert chat_format.conversations_read(chat_format.read_back(chat_format.format_turns(frame.limit(0)))).count() == 0


# ---- whitening

def vectors(n=400, d=24, seed=2):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((n, d)) * np.linspace(1, 0.2, d) + 0.3


def embedded(spark, x, extra=()):
    rows = [(k, [float(v) for v in r], "c") for k, r in enumerate(x)] + [(10_000 + k, v, "c") for k, v in enumerate(extra)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, vector string").repartition(3)


def check_whitened(spark, x, extra=(), kept=8):
    got = whitening.whiten(embedded(spark, x, extra)).collect()
    z = np.floor(1024 * x).astype(np.int64) + 100_000
    n, sums = len(z), z.sum(0)
    centred = z - sums / n
    values, vec = np.linalg.eigh(centred.T @ centred / n)
    values, vec = values[::-1], vec[:, ::-1]
    assert len(got) == n * kept and {r.n for r in got} == {n}
    white = np.zeros((n, kept))
    for r in got:
        white[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(z[r.vec_id], sums))
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    want = centred @ vec[:, :kept] / np.sqrt(values[:kept])
    assert np.abs(white.T @ white / n - np.eye(kept)).max() < 1e-9 and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    return white, want


def test_whitening_equals_numpy(spark):
    d = 24
    bad = [None, [None] * d, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [1.0], [], [1e300] * d]
    white, want = check_whitened(spark, vectors(), bad)
    for k in range(8):
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) < 1e-8


def test_whitening_of_equal_eigenvalues(spark):
    """Signed unit vectors: all eigenvalues are equal up to rounding, so only the whitened covariance is defined."""
    d = 12
    x = np.vstack([np.eye(d), -np.eye(d)])
    check_whitened(spark, np.vstack([x, x, x]))


def test_whitening_of_large_entries(spark):
    x = np.random.default_rng(3).standard_normal((50, 3)) * 1e7
    got = whitening.whiten(embedded(spark, x)).collect()
    z = np.floor(1024 * x).astype(np.int64) + 100_000
    exact = {k: sum((50 * int(a) - int(s)) ** 2 for a, s in zip(z[k], z.sum(0))) for k in range(50)}
    assert {r.vec_id: r.deviation for r in got} == {k: v if v < 1 << 63 else None for k, v in exact.items()}


def test_whitening_without_variance(spark):
    assert whitening.whiten(embedded(spark, np.ones((5, 4)))).count() == 0
    assert whitening.whiten(embedded(spark, np.ones((1, 4)))).count() == 0
    assert whitening.whiten(embedded(spark, np.ones((1, 4))).limit(0)).count() == 0
    line = np.outer(np.arange(20.0), [1.0, 2.0, 0.0])  # one direction only
    assert {r.component for r in whitening.whiten(embedded(spark, line)).collect()} == {1}


@pytest.mark.parametrize("spread", [1.0, 1e-5, 1e-9, 0.0])
def test_refined_eigenvectors_of_clusters(spread):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    values = np.sort(np.concatenate([5 + spread * np.arange(6), 2 + spread * np.arange(4), rng.uniform(0.1, 1, 30)]))[::-1]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    got, x = whitening.refined_eigenvectors(a)
    assert np.abs(got - values).max() < 1e-13 * values[0] * 10
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-14 and np.abs(a @ x - x * got).max() < 1e-13 * values[0]


# ---- conversation repair

def damage(rows):
    text = lambda v: " " if v is None else str(v)
    out = []
    for conv, turn, role, body in rows:
        k = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, body = "user" if k == 4 else text(role), text(body)
        body = "" if k == 1 else "".join(c for c in body if c not in ".!?") if k == 2 else body
        out += [] if k == 0 else [(conv, turn, role, body)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    """(initial, must go, truncated) and kind of each row, in order."""
    out, seen = [], set()
    for _, _, role, body in rows:
        solid = body.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not solid else "duplicate" if (role, body) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, body))
        out.append((role[:1], kind in ("blank", "duplicate"), kind == "truncated", kind))
    return out


def cheapest(turns):
    """Smallest (cost, audit) by a search over all strings of at most ``len(turns) + 4`` roles: a plain table over
    (turns read, roles written), without stacks."""
    best = None
    for system in (False, True):
        size = len(turns) * 2 + 4
        role = lambda j: "s" if system and j == 0 else "ua"[(j - system) % 2]
        table = {(0, 0): (0, "")}
        for i in range(len(turns) + 1):
            for j in range(size):
                if (i, j) not in table:
                    continue
                cost, audit = table[i, j]
                ways = []
                if role(j) != "s":
                    ways.append((i, j + 1, cost + 2, audit + "I"))
                if i < len(turns):
                    initial, must, cut, _ = turns[i]
                    ways.append((i + 1, j, cost + 3, audit + "D"))
                    if not must:
                        if initial == role(j):
                            ways.append((i + 1, j + 1, cost + cut, audit + "K"))
                        if role(j) != "s":
                            ways.append((i + 1, j + 1, cost + 2 + cut, audit + "R"))
                for a, b, c, w in ways:
                    if (a, b) not in table or (c, w) < table[a, b]:
                        table[a, b] = c, w
        for j in range(size):
            if (len(turns), j) in table and ((not system and j % 2 == 0) or (system and j % 2 == 1 and j > 1)):
                best = min(best or table[len(turns), j], table[len(turns), j])
    return best


def written(rows, audit):
    size = len(audit) - audit.count("D")
    out, rows = [], iter(rows)
    for edit in audit:
        name = ("user", "assistant")[(len(out) - size % 2) % 2]
        if edit == "I":
            out.append(f"{name}:")
            continue
        _, _, role, body = next(rows)
        if edit != "D":
            out.append(f"{role if edit == 'K' else name}:{body}")
    return sha("\n".join(out))


@pytest.mark.parametrize("seed", range(40))
def test_repair_equals_a_plain_table(seed):
    rnd = random.Random(seed)
    parser = conversation_repair.Repair()
    for _ in range(60):
        turns = [(rnd.choice("uuaasx "), rnd.random() < 0.2, rnd.random() < 0.2, "") for _ in range(rnd.randint(0, 9))]
        course = conversation_repair.Course(parser)
        for t in turns:
            course.add(*t[:3])
        assert course.result() == cheapest(turns)
    assert len(parser.state) <= 20  # stacks are shared, whatever the length


def test_repair_of_conversations(spark, frame, talks):
    turns = conversation_repair.damaged(frame)
    got = {r.conv_id: r for r in conversation_repair.repair(turns).collect()}
    given = by_conv(talks)
    after = by_conv(damage(talks))
    key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest())
    assert set(got) == set(given)
    for conv in given:
        rows = sorted(after.get(conv, []), key=key)
        marked = faults(rows)
        count = lambda kind: sum(m[3] == kind for m in marked)
        at = [r[1] for r in rows if r[1] is not None]
        pairs = [a[0] + b[0] for a, b in zip(marked, marked[1:])]
        cost, audit = cheapest(marked) if len(marked) < 100 else (got[conv].cost, got[conv].audit)
        want = (max(at) - min(at) + 1 - len(set(at)) if at else 0, count("blank"), count("duplicate"), count("truncated"),
                sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, written(rows, audit))
        g = got[conv]
        assert (g.gaps, g.blank, g.duplicate, g.truncated, g.illegal, g.cost, g.audit, g.repaired_sha256) == want, conv
    long = [r for r in got.values() if len(r.audit) > 2000]
    assert len(long) == 1 and len(parser_heads()) < 400


def parser_heads():
    """Combinations of heads that 3,000 turns with faults of every kind need."""
    rnd, parser = random.Random(1), conversation_repair.Repair()
    course = conversation_repair.Course(parser)
    for _ in range(3000):
        course.add(rnd.choice("uas"), rnd.random() < 0.1, rnd.random() < 0.1)
    course.result()
    return {heads for heads, _ in parser.steps}


def test_repaired_turns_follow_the_grammar(spark, frame):
    turns = conversation_repair.damaged(frame)
    plans = conversation_repair.repair_plans(turns)
    rows = conversation_repair.repaired_turns(turns, plans).orderBy("conv_id", "place").collect()
    by = {}
    for r in rows:
        assert r.place == len(by.setdefault(r.conv_id, []))
        by[r.conv_id].append(r.role[0])
    import re
    assert all(re.fullmatch("s?(ua)+", "".join(v)) for v in by.values())


def test_repair_of_nothing(spark, frame):
    assert conversation_repair.repair(conversation_repair.damaged(frame.limit(0))).count() == 0


def test_empty_and_extreme_turns(spark):
    rows = [(1, None, "user", "a."), (1, None, "assistant", "b."), (2, -2**63, "user", "a."), (2, 2**63 - 1, "assistant", "b.")]
    turns = spark.createDataFrame([(*r, False) for r in rows], "conv_id long, turn long, role string, text string, gone boolean")
    got = {r.conv_id: (r.gaps, r.cost, r.audit) for r in conversation_repair.repair(turns).collect()}
    assert got == {1: (0, 4, "IKKI"), 2: (None, 0, "KK")}  # turns of one place go by role
