r"""Conversation structure repair: generalised LR parsing with weighted edits.

Conversations must follow a role grammar, ``(s?(ua)+)?`` over the initials of the roles. Faulty
ones are repaired by the cheapest edits: keep a turn, delete it, give it another role, insert an
empty turn.

* Tables: an SLR automaton is made from the productions (``GRAMMAR``) by closure and goto.
* Graph-structured stack: a vertex is a parser state on top of another vertex; equal stacks are one
  vertex, so all alternatives share their lower parts. The grammar is left
  recursive, so there are as many vertices as distinct stacks (16), whatever the length.
* Every alternative tries all edits at every turn: inserts (shifts of tokens that are not there),
  then one of delete (no shift), keep or rerole (shift). Alternatives that reach the same vertex merge: the
  smallest (cost, audit) stays. Audits of one turn end in that turn's only letter other than I, so none is
  a prefix of another, and they can be compared through their rank and the new letters.
* Alternatives dearer than the cheapest by more than ``SLACK`` are dropped: from any stack the rest of any
  other can be followed after closing an open pair (at most two inserts, 4) and deleting one kept
  system turn (3), so they can neither win nor tie. What is left repeats (vertices, cost differences, ranks), so
  each combination is worked out once per worker and looked up afterwards.

Two passes of rows sorted by conversation and turn, both streamed: the first, without
texts (initials and flags), finds the audit; the second reads the conversation's audit
row first and then its turns, and applies it. A task holds eight bytes a turn of the conversation
it is in, never its texts. Audit and digest are one value a conversation, so one that holds a third of all rows
is read by one task in each pass. Which turns repeat an earlier one is found by a grouped minimum over
(conversation, role, digest of the text) beforehand, without any list of a conversation's texts.

Edge cases. NULL conv_id, turn, role or text: one space in the damage key, role or text; NULL conv_ids are
one conversation, returned with NULL. Turns are ordered by turn (NULL first), then role, then digest of the
text. Repeated rows are turns of their own (duplicates). ``gaps`` is NULL where it exceeds a long.
An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import land, ship, table, worker_cache

ship(__name__)

#: Start symbol first. Terminals are the initials s, u, a.
GRAMMAR = (("conversation", ()), ("conversation", ("turns",)), ("conversation", ("s", "turns")),
           ("turns", ("pair",)), ("turns", ("turns", "pair")), ("pair", ("u", "a")))
ROLES = {"u": "user", "a": "assistant"}  # what a rerole or an insert can give
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SLACK = 2 * INSERT + DELETE
END = "$"
SPACE = r"\x20\x09-\x0D"
MOST_HELD = 100_000  # remembered combinations a worker; then it starts again


class Tables:
    """SLR tables of a grammar: ``goto[state, symbol]`` and ``reduce[state, terminal]`` (productions)."""

    def __init__(self, grammar=GRAMMAR):
        self.start = grammar[0][0]
        heads = {a for a, _ in grammar}
        empty = {a for a, right in grammar if not right}
        first = {a: set() for a in heads}
        follow = {a: set() for a in heads}
        follow[self.start].add(END)
        before = None
        while before != (now := (len(empty), *(len(x) for x in (*first.values(), *follow.values())))):
            before = now
            for a, right in grammar:
                if all(x in empty for x in right):
                    empty.add(a)
                for x in right:
                    first[a] |= first.get(x, {x})
                    if x not in empty:
                        break
                rest = set(follow[a])
                for x in reversed(right):
                    if x in heads:
                        follow[x] |= rest
                        rest = rest | first[x] if x in empty else set(first[x])
                    else:
                        rest = {x}

        def closed(items: set) -> frozenset:
            todo = list(items)
            while todo:
                _, right, dot = todo.pop()
                for a, r in grammar:
                    if dot < len(right) and a == right[dot] and (a, r, 0) not in items:
                        items.add((a, r, 0))
                        todo.append((a, r, 0))
            return frozenset(items)

        number = {closed({(a, r, 0) for a, r in grammar if a == self.start}): 0}
        self.goto, self.reduce = {}, {}
        todo = list(number)
        while todo:
            state = todo.pop()
            for x in {right[dot] for _, right, dot in state if dot < len(right)}:
                after = closed({(a, right, dot + 1) for a, right, dot in state if dot < len(right) and right[dot] == x})
                if after not in number:
                    number[after] = len(number)
                    todo.append(after)
                self.goto[number[state], x] = number[after]
            for a, right, dot in state:
                if dot == len(right):
                    for x in follow[a]:
                        self.reduce.setdefault((number[state], x), []).append((a, len(right)))


class Repair:
    """The graph-structured stack with its weighted edits, one turn at a time."""

    def __init__(self):
        self.tables = Tables()
        self.state, self.below, self.known = [0], [-1], {(0, -1): 0}
        self.closures, self.steps = {}, {}

    def vertex(self, state: int, below: int) -> int:
        key = state, below
        if key not in self.known:
            self.known[key] = len(self.state)
            self.state.append(state)
            self.below.append(below)
        return self.known[key]

    def reduced(self, v: int, terminal: str) -> set[int]:
        """All stacks that reductions before ``terminal`` give, ``v`` included."""
        seen, todo = {v}, [v]
        while todo:
            top = todo.pop()
            for head, size in self.tables.reduce.get((self.state[top], terminal), ()):
                base = top
                for _ in range(size):
                    base = self.below[base]
                after = self.tables.goto.get((self.state[base], head))
                if after is None:
                    continue
                new = self.vertex(after, base)
                if new not in seen:
                    seen.add(new)
                    todo.append(new)
        return seen

    def shift(self, v: int, terminal: str) -> list[int]:
        return [self.vertex(self.tables.goto[self.state[w], terminal], w) for w in self.reduced(v, terminal)
                if (self.state[w], terminal) in self.tables.goto]

    def accepts(self, v: int) -> bool:
        # the start symbol is complete when one of its productions can be reduced onto the bottom
        for w in self.reduced(v, END):
            for head, size in self.tables.reduce.get((self.state[w], END), ()):
                base = w
                for _ in range(size):
                    base = self.below[base]
                if head == self.tables.start and base == 0:
                    return True
        return False

    def inserted(self, v: int) -> dict[int, tuple[int, str]]:
        """vertex -> smallest (cost, letters) that inserts alone need to reach it."""
        if v not in self.closures:
            best, todo = {v: (0, "")}, [v]
            while todo:
                w = todo.pop()
                cost, letters = best[w]
                for terminal in ROLES:
                    for x in self.shift(w, terminal):
                        new = cost + INSERT, letters + "I"
                        if x not in best or new < best[x]:
                            best[x] = new
                            todo.append(x)
            self.closures[v] = best
        return self.closures[v]

    def edits(self, v: int, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[int, int, str]]:
        """(vertex, cost, letters) of every way past a turn."""
        for w, (cost, letters) in self.inserted(v).items():
            yield w, cost + DELETE, letters + "D"
            if must_go:
                continue
            for x in self.shift(w, initial):
                yield x, cost + truncated * TRUNCATED, letters + "K"
            for terminal in ROLES:
                for x in self.shift(w, terminal):
                    yield x, cost + REROLE + truncated * TRUNCATED, letters + "R"

    def step(self, heads: tuple, turn: tuple) -> tuple:
        """(heads, cost of the cheapest, where each came from). A head is (vertex, cost above the cheapest, rank of
        its audit); where it came from: (place of the head before, letters)."""
        if (heads, turn) not in self.steps:
            best: dict[int, tuple] = {}
            for place, (v, cost, rank) in enumerate(heads):
                for w, more, letters in self.edits(v, *turn):
                    new = cost + more, rank, letters, place
                    if w not in best or new < best[w]:
                        best[w] = new
            least = min(x[0] for x in best.values())
            live = sorted((w, x) for w, x in best.items() if x[0] <= least + SLACK)
            ranks = {k: r for r, k in enumerate(sorted({(x[1], x[2]) for _, x in live}))}
            if len(self.steps) >= MOST_HELD:
                self.steps.clear()
            self.steps[heads, turn] = (tuple((w, x[0] - least, ranks[x[1], x[2]]) for w, x in live), least,
                                       tuple((x[3], x[2]) for _, x in live))
        return self.steps[heads, turn]

    def end(self, heads: tuple) -> tuple[int, int, str]:
        """(cost, place, trailing letters) of the best alternative that the grammar takes."""
        cost, _, letters, place = min((cost + more, rank, letters, place) for place, (v, cost, rank) in enumerate(heads)
                                      for w, (more, letters) in self.inserted(v).items() if self.accepts(w))
        return cost, place, letters


class Course:
    """The repair of one conversation, turn by turn."""

    FIRST = ((0, 0, 0),)

    def __init__(self, repair: Repair):
        self.repair, self.heads, self.cost, self.trail = repair, self.FIRST, 0, []

    def add(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.heads, least, back = self.repair.step(self.heads, (initial, must_go, truncated))
        self.cost += least
        self.trail.append(back)

    def result(self) -> tuple[int, str]:
        """(cost, audit)."""
        more, place, letters = self.repair.end(self.heads)
        parts = [letters]
        for back in reversed(self.trail):
            place, letters = back[place]
            parts.append(letters)
        return self.cost + more, "".join(reversed(parts))


def damaged(rows: DataFrame) -> DataFrame:
    """Every row of ``rows`` after damage by its conv_id and turn; ``gone`` marks the dropped ones, which stay
    so that no conversation is lost."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"])) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(filled["text"], "[.!?]", ""))
            .otherwise(filled["text"]))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(filled["role"]).alias("role"), text.alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def flagged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, key, initial, blank, open, gone, again`` of turns (conv_id, turn, role, text, gone), without their texts.
    ``again``: the same role and text stand at a smaller turn of the conversation."""
    at = F.struct(F.col("turn").isNotNull().alias("set"), F.col("turn").alias("turn"))  # NULL is smaller than any turn
    slim = turns.select(
        "conv_id", "turn", "role", "gone", F.unhex(F.md5("text")).alias("key"), F.substring("role", 1, 1).alias("initial"),
        (~F.rlike("text", F.lit(f"[^{SPACE}]"))).alias("blank"),
        (~F.rlike("text", F.lit(rf"[.!?][{SPACE}]*\z"))).alias("open"))
    first = (slim.where(~F.col("gone")).groupBy("conv_id", "role", "key").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(*[F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "key")], "first"))
    same = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in ("conv_id", "role", "key")]
    return slim.join(first, same[0] & same[1] & same[2], "left").select(
        *slim.columns, F.coalesce(at > F.col("first"), F.lit(False)).alias("again"))


_PLAN = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
         "audit string")
_PLAN_NAMES = [c.split(" ")[0] for c in _PLAN.split(", ")]
_LEGAL = {"su", "ua", "au"}


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Rows of a conversation in one task, in order."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", *more, "turn", "role", "key")]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _batch(rows: list, types: list, names: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def repair_plans(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, gone): faults, cost and audit."""
    names = ["conv_id", "turn", "role", "key", "initial", "blank", "open", "gone", "again"]
    types = [pa.int64()] * 7 + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_cache()
        if "conversation repair" not in held:
            held["conversation repair"] = Repair()
        repair = held["conversation repair"]
        course, out = None, []

        def close() -> None:
            gaps = max(0, high - low + 1 - many) if many else 0
            out.append((conv, gaps if gaps < 1 << 63 else None, blanks, repeats, cut, illegal, *course.result()))

        for batch in batches:
            for c, turn, role, key, initial, blank, open_, gone, again in zip(*(batch[x].to_pylist() for x in names)):
                if course is None or c != conv:
                    if course is not None:
                        close()
                    course, conv = Course(repair), c
                    blanks = repeats = cut = illegal = many = 0
                    before = low = high = last = None
                if gone:
                    continue
                again = again or last == (turn, role, key)  # equal rows of one turn lie together
                if turn is not None and turn != high:
                    low, high, many = turn if low is None else low, turn, many + 1
                if before is not None and before + initial not in _LEGAL:
                    illegal += 1
                if blank:
                    blanks += 1
                elif again:
                    repeats += 1
                elif open_:
                    cut += 1
                course.add(initial, blank or again, open_ and not blank and not again)
                before, last = initial, (turn, role, key)
            if out:
                yield _batch(out, types, _PLAN_NAMES)
                out.clear()
        if course is not None:
            close()
            yield _batch(out, types, _PLAN_NAMES)

    return _in_order(flagged(turns)).mapInArrow(run, _PLAN)


def _applied(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, audit, role, text), each conversation's rows together and in order: its audit, then its repaired turns."""
    head = plans.select("conv_id", F.lit(False).alias("body"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                        F.lit(None).cast("binary").alias("key"), F.lit("").alias("text"), "audit")
    body = turns.where(~F.col("gone")).select("conv_id", F.lit(True).alias("body"), "turn", "role", F.unhex(F.md5("text")).alias("key"), "text",
                                              F.lit(None).cast("string").alias("audit"))
    names, types = ["conv_id", "audit", "role", "text"], [pa.int64(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, at, place, system = "", 0, 0, False

        def made(conv) -> Iterator[tuple]:
            """The inserted turns that come next."""
            nonlocal at, place
            while at < len(edits) and edits[at] == "I":
                yield conv, None, ROLES["ua"[(place - system) % 2]], ""
                at, place = at + 1, place + 1

        for batch in batches:
            out = []
            for conv, is_body, role, text, audit in zip(*(batch[x].to_pylist() for x in ("conv_id", "body", "role", "text", "audit"))):
                if not is_body:
                    edits, at, place = audit, 0, 0
                    system = (len(edits) - edits.count("D")) % 2 == 1  # pairs, and a system turn where one is left
                    out.append((conv, audit, None, None))
                    out += made(conv)
                    continue
                edit = edits[at]
                at += 1
                if edit != "D":
                    out.append((conv, None, role if edit == "K" else ROLES["ua"[(place - system) % 2]], text))
                    place += 1
                out += made(conv)
            if out:
                yield _batch(out, types, names)

    return _in_order(head.union(body), "body").mapInArrow(run, "conv_id bigint, audit string, role string, text string")


def repaired_turns(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text: the repaired conversations' turns."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = 0
        for batch in batches:
            out = []
            for conv, audit, role, text in zip(*(batch[x].to_pylist() for x in ("conv_id", "audit", "role", "text"))):
                if audit is not None:
                    place = 0
                else:
                    out.append((conv, place, role, text))
                    place += 1
            yield _batch(out, [pa.int64(), pa.int64(), pa.string(), pa.string()], ["conv_id", "place", "role", "text"])

    return _applied(turns, plans).mapInArrow(number, "conv_id bigint, place bigint, role string, text string")


def repaired_digests(turns: DataFrame, plans: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: digest of the repaired turns' ``role:text``, newline between."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, first, conv, types, names = None, True, None, [pa.int64(), pa.string()], ["conv_id", "repaired_sha256"]
        for batch in batches:
            out = []
            for c, audit, role, text in zip(*(batch[x].to_pylist() for x in ("conv_id", "audit", "role", "text"))):
                if audit is not None:
                    if h is not None:
                        out.append((conv, h.hexdigest()))
                    h, first, conv = hashlib.sha256(), True, c
                else:
                    h.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
            if out:
                yield _batch(out, types, names)
        if h is not None:
            yield _batch([(conv, h.hexdigest())], types, names)

    return _applied(turns, plans).mapInArrow(digest, "conv_id bigint, repaired_sha256 string")


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, gone): faults, cost, audit, repaired_sha256."""
    plans = land(repair_plans(turns), "conversation-plans")
    done = repaired_digests(turns, plans).withColumnRenamed("conv_id", "r_conv")
    return plans.join(done, F.col("conv_id").eqNullSafe(F.col("r_conv"))).drop("r_conv")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


_STEP = "list_reduce([{0}, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
_CRC = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda x: ord(x)::BIGINT)), "
        "lambda c, b: " + _STEP.format("xor(c, b)") + "), 4294967295)")


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _plus(state: str, cost: object, letters: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'w': {state}.w || '{letters}'}}"


_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NEVER = "{'c': 1000000000000::BIGINT, 'w': ''}"
#: The four places a conversation can be in: empty, after the system turn, after a user turn, after a pair.
ORACLE = f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k
  FROM conversations),
dam AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM src WHERE k <> 0),
num AS (
  SELECT *, left(role, 1) AS i, rtrim(text, {_SPACES}) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS n FROM dam),
flag AS (
  SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
    right(body, 1) NOT IN ('.', '!', '?') AS open, lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i AS pair FROM num),
row_ AS MATERIALIZED (
  SELECT conv_id, n, role, text, i, turn, pair, blank, NOT blank AND again AS dup, NOT blank AND NOT again AND open AS cut FROM flag),
facts AS (
  SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM row_ GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS n, {{'c': 0::BIGINT, 'w': ''}} AS e, {_NEVER} AS s, {_NEVER} AS u, {_NEVER} AS a FROM facts
  UNION ALL
  SELECT conv_id, n, {_plus("e", DELETE, "D")},
    {_least(_plus("s", DELETE, "D"), f"CASE WHEN NOT gone AND i = 's' THEN {_plus('e', 't', 'K')} ELSE {_NEVER} END")},
    {_least(_plus("u", DELETE, "D"), f"CASE WHEN NOT gone AND i = 'u' THEN {_plus('m', 't', 'K')} ELSE {_NEVER} END",
            f"CASE WHEN NOT gone THEN {_plus('m', f'{REROLE} + t', 'R')} ELSE {_NEVER} END")},
    {_least(_plus("a", DELETE, "D"), f"CASE WHEN NOT gone AND i = 'a' THEN {_plus('u', 't', 'K')} ELSE {_NEVER} END",
            f"CASE WHEN NOT gone THEN {_plus('u', f'{REROLE} + t', 'R')} ELSE {_NEVER} END")}
  FROM (
    SELECT *, {_least("e", "s", "a")} AS m FROM (
      SELECT w.conv_id, r.n, r.i, r.blank OR r.dup AS gone, r.cut::BIGINT AS t, e, s,
        {_least("u", *(_plus(x, INSERT, "I") for x in "esa"))} AS u,
        {_least("a", _plus("u", INSERT, "I"), *(_plus(x, 2 * INSERT, "II") for x in "es"))} AS a
      FROM walk w JOIN row_ r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.n = w.n + 1))),
plan AS (
  SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal,
    {_least("e", "a", _plus("u", INSERT, "I"), _plus("s", 2 * INSERT, "II"))} AS best
  FROM facts f JOIN walk w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n),
letters AS (
  SELECT conv_id, j, substr(w, j, 1) AS edit, length(replace(w, 'D', '')) AS size,
    length(replace(left(w, j), 'I', '')) AS n, length(replace(left(w, j), 'D', '')) AS place
  FROM (SELECT conv_id, best.w AS w, unnest(range(1, length(best.w) + 1)) AS j FROM plan)),
text_ AS (
  SELECT l.conv_id, sha256(string_agg(
      CASE WHEN edit = 'K' THEN role WHEN (place - size) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':'
      || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j)) AS h
  FROM letters l LEFT JOIN row_ r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n
  WHERE edit <> 'D' GROUP BY l.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.w, '') AS audit,
  coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN plan p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN text_ t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""
