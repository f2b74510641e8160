"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn followed by user and
assistant turns in alternation that start with a user and end with an
assistant. The automaton of legal turns has the states ``start``, ``system``
(read), ``user`` and ``assistant`` (last turn). Each source turn takes one
step; a step is any of

* keep it as its own role's next turn (0),
* merge it into the turn before, if that has its role (``MERGE``),
* relabel it to another role, as a new turn (``RELABEL``) or merged into the
  turn before (``RELABEL + MERGE``),

and before a turn, or at the end, empty turns of the missing roles may be
inserted (``INSERT`` each). A role that is none of the three costs
``RELABEL`` wherever it goes. The repair is the path of least total cost;
among equal ones, the one whose states are smallest, compared from the last
turn backwards.

A step is a 4 x 4 matrix of costs (state before, state after), and steps
combine by (min, +) products, which are associative. Turns are sorted by
range into bounded partitions. A conversation inside one partition is
repaired there. One that reaches a partition's border may go on in the next
one (a hot conversation covers many); each of its pieces becomes one matrix,
the few matrices of a conversation are chained to the cost of reaching each
state before each piece, every piece then has its best path for each of the
four states it may end in, and a chain backwards picks one of them.

The rendering has one piece per source or inserted turn; a merged turn is
several pieces. A piece that opens a turn closes the turn before it, and the
last piece of a conversation closes its own, so no piece needs its
successor. Joining ``rendered`` in order of (turn, source_role, piece) gives
the conversation, without any row growing with it.

Defined cases: turns are ordered by turn number (null first), then role and
text, so repeated rows are repeated turns; a null role is an unknown role;
null text is empty; a null conv_id is one conversation; an empty table gives
an empty result; control strings inside a text are escaped by a zero-width
joiner; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import materialize
from .common import bounded_batches, partitions, trimmed

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, INSERT = 2, 3, 4
FAR = 1 << 40
OPEN, CLOSE = "<|im_start|>{}\n", "<|im_end|>\n"
CONTROL = ("<|im_start|>", "<|im_end|>")
#: Empty turns that lead from a state to a state in which a new turn of a role may follow: by (state, role), those inserted.
FOLLOW = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}


def _inserts(state: int, role: int) -> tuple[int, ...] | None:
    """Roles of the empty turns needed between ``state`` and a new turn of ``role``; None if there is no way."""
    if state in FOLLOW[role]:
        return ()
    if role == USER and state == USER:
        return (ASSISTANT,)
    if role == ASSISTANT and state in (START, SYSTEM, ASSISTANT):
        return (USER,)
    return None


def steps(role: int) -> list[list[tuple[int, str, tuple[int, ...]]]]:
    """By (state before, state after): cost, action and inserted roles of the cheapest step for a turn of ``role`` (-1: unknown)."""
    out = [[(FAR, "", ())] * 4 for _ in range(4)]
    for s in range(4):
        for e in (SYSTEM, USER, ASSISTANT):
            change = RELABEL * (e != role)
            ways = []
            empty = _inserts(s, e)
            if empty is not None:
                ways.append((change + INSERT * len(empty), "relabel" if change else "keep", empty))
            if s == e:
                ways.append((change + MERGE, "relabel+merge" if change else "merge", ()))
            if ways:
                out[s][e] = min(ways, key=lambda w: (w[0], len(w[2]), w[1]))
    return out


STEPS = [steps(r) for r in (SYSTEM, USER, ASSISTANT, -1)]
COSTS = np.array([[[way[0] for way in row] for row in table] for table in STEPS], np.int64)


def last_inserts(state: int) -> tuple[int, ...]:
    """Empty turns that end a conversation legally."""
    return {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}[state]


END = np.array([INSERT * len(last_inserts(s)) for s in range(4)], np.int64)


def piece_matrix(kinds: np.ndarray) -> np.ndarray:
    """Cost matrix of a run of turns, by a tree of products."""
    m = COSTS[kinds]
    while len(m) > 1:
        if len(m) % 2:
            tail = m[-1:]
            m = np.concatenate([(m[:-1:2, :, :, None] + m[1::2, None, :, :]).min(2).clip(max=FAR), tail])
        else:
            m = (m[::2, :, :, None] + m[1::2, None, :, :]).min(2).clip(max=FAR)
    return m[0]


def solve(kinds: np.ndarray, before: np.ndarray) -> np.ndarray:
    """By state it ends in, the states before each turn and after the last (4 x turns + 1); ``before``: costs to get there."""
    n = len(kinds)
    reach = np.empty((n + 1, 4), np.int64)
    reach[0] = before
    back = np.empty((n, 4), np.int64)
    for t in range(n):
        ways = reach[t][:, None] + COSTS[kinds[t]]
        back[t] = ways.argmin(0)
        reach[t + 1] = ways.min(0).clip(max=FAR)
    path = np.empty((4, n + 1), np.int64)
    path[:, n] = range(4)
    for t in range(n - 1, -1, -1):
        path[:, t] = back[t][path[:, t + 1]]
    return path


ORIGIN = np.array([0, FAR, FAR, FAR], np.int64)


def ends(kinds: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Cost of each state after a run of turns."""
    return (before[:, None] + piece_matrix(kinds)).min(0).clip(max=FAR)


def best_end(cost: np.ndarray) -> int:
    return int(np.argmin(cost + END))


def escape(text: str) -> str:
    for c in CONTROL:
        text = text.replace(c, c[:1] + "‍" + c[1:])
    return text


def _kinds(roles: list) -> np.ndarray:
    at = {"system": 0, "user": 1, "assistant": 2}
    return np.array([at.get(r, 3) for r in roles], np.int64)


def pieces(kind: int, was: int, now: int, text: str | None, final: bool) -> list[tuple[int, str, str, str]]:
    """(piece, role, action, rendered) of one source turn of a kind between two states."""
    _, action, empty = STEPS[kind][was][now]
    out, close = [], "" if was == START else CLOSE
    for state in empty:
        out.append((ROLES[state - 1], "insert", close + OPEN.format(ROLES[state - 1])))
        close = CLOSE
    text = escape(text or "")
    out.append((ROLES[now - 1], action, "\n" + text if action.endswith("merge") else close + OPEN.format(ROLES[now - 1]) + text))
    if final:
        for state in last_inserts(now):
            out.append((ROLES[state - 1], "insert", CLOSE + OPEN.format(ROLES[state - 1])))
        out[-1] = *out[-1][:2], out[-1][2] + CLOSE
    return [(k, *x) for k, x in enumerate(out)]


def repair(roles: list, texts: list) -> list[tuple[int, int, str, str, str]]:
    """(source index, piece, role, action, rendered) of a whole conversation."""
    kinds = _kinds(roles)
    if not len(kinds):
        return []
    every = solve(kinds, ORIGIN)
    path = every[best_end(ends(kinds, ORIGIN))].tolist()
    return [(t, *p) for t, k in enumerate(kinds.tolist())
            for p in pieces(k, path[t], path[t + 1], texts[t], t + 1 == len(kinds))]


COLUMNS = ["piece", "role", "action", "rendered"]


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, turn, source_role, piece, role, action, rendered: one row per source turn and per inserted turn."""
    spark = turns.sparkSession
    bounded_batches(turns)
    kind, turn_kind = (turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    # the row number splits a run of equal turns over partitions as well
    rows = turns.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("n"))
    keys = ["conv_id", "turn", "role", "h", "n"]
    rows = (rows.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys)
            .select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("part")))
    fields = (f"conv_id {kind}, turn {turn_kind}, source_role string, part int, at long, border boolean, "
              "piece int, role string, action string, rendered string")
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The conversations of a partition; the first and the last one stay unsolved."""
        held: list[dict] = []
        first, at = True, 0

        def done(border: bool) -> list[tuple]:
            nonlocal at
            out = []
            if border:
                out = [(r["conv_id"], r["turn"], r["role"], r["part"], at + k, True, None, None, None, r["text"])
                       for k, r in enumerate(held)]
            else:
                for t, *p in repair([r["role"] for r in held], [r["text"] for r in held]):
                    r = held[t]
                    out.append((r["conv_id"], r["turn"], r["role"], r["part"], at + t, False, *p))
            at += len(held)
            return out

        ready: list[tuple] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and r["conv_id"] != held[0]["conv_id"]:
                    ready += done(first)
                    held, first = [], False
                held.append(r)
                if len(ready) > 2000:
                    yield _batch(ready)
                    ready = []
        if held:
            ready += done(True)
        if ready:
            yield _batch(ready)

    schema = _arrow(turns, names)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, schema.field(k).type) for k, c in enumerate(zip(*rows))], schema=schema)

    stage = materialize(rows.mapInArrow(trimmed(runs), fields), "chat-pieces")
    solved = stage.where("not border").select("conv_id", "turn", "source_role", *COLUMNS)
    border = stage.where("border").select("conv_id", "turn", "source_role", "part", "at", F.col("rendered").alias("text"))

    def matrix(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        m = piece_matrix(_kinds(group.column("source_role").to_pylist()))
        return pa.table({"conv_id": group.column("conv_id")[:1], "part": group.column("part")[:1],
                         "cost": pa.array([m.reshape(-1).tolist()], pa.list_(pa.int64()))})

    def onward(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        reach = [ORIGIN]
        for m in group.column("cost").to_pylist():
            reach.append((reach[-1][:, None] + np.array(m).reshape(4, 4)).min(0).clip(max=FAR))
        n = group.num_rows
        return pa.table({"conv_id": group.column("conv_id"), "part": group.column("part"),
                         "before": pa.array([r.tolist() for r in reach[:-1]], pa.list_(pa.int64())),
                         "final": pa.array([k + 1 == n for k in range(n)]),
                         "last": pa.array([best_end(reach[-1])] * n, pa.int32())})

    key = ["conv_id", "part"]
    costs = border.select(*key, "at", "source_role").groupBy(*key).applyInArrow(matrix, f"conv_id {kind}, part int, cost array<bigint>")
    reached = materialize(costs.groupBy("conv_id").applyInArrow(
        onward, f"conv_id {kind}, part int, before array<bigint>, final boolean, last int"), "chat-reach")

    def paths(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("at")
        p = solve(_kinds(left.column("source_role").to_pylist()), np.array(right.column("before")[0].as_py(), np.int64))
        left = left.append_column("was", pa.array(p[:, :-1].T.tolist(), pa.list_(pa.int32())))
        left = left.append_column("now", pa.array(p[:, 1:].T.tolist(), pa.list_(pa.int32())))
        final = right.column("final")[0].as_py()
        return left.append_column("final", pa.array([final and k + 1 == left.num_rows for k in range(left.num_rows)]))

    four = materialize(border.groupBy(*key).cogroup(reached.groupBy(*key)).applyInArrow(
        paths, f"conv_id {kind}, turn {turn_kind}, source_role string, part int, at long, text string, "
               "was array<int>, now array<int>, final boolean"), "chat-paths")

    def backward(group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "descending")])
        end, out = group.column("last")[0].as_py(), []
        for start in group.column("starts").to_pylist():
            out.append(end)
            end = start[end]
        return pa.table({"conv_id": group.column("conv_id"), "part": group.column("part"), "end": pa.array(out, pa.int32())})

    starts = four.groupBy(*key).agg(F.min_by("was", "at").alias("starts"))
    known = reached.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "last")
    chosen = (starts.join(known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")))
              .select("conv_id", "part", "starts", "last").groupBy("conv_id")
              .applyInArrow(backward, f"conv_id {kind}, part int, end int"))
    chosen = materialize(chosen, "chat-ends").select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "end")
    walked = four.join(chosen, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).select(
        "conv_id", "turn", "source_role", "text", "final", F.get("was", F.col("end")).alias("was"), F.get("now", F.col("end")).alias("now"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                k = int(_kinds([r["source_role"]])[0])
                rows += [(r["conv_id"], r["turn"], r["source_role"], *p) for p in pieces(k, r["was"], r["now"], r["text"], r["final"])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, short.field(k).type) for k, c in enumerate(zip(*rows))], schema=short)

    short = _arrow(turns, ["conv_id", "turn", "source_role", *COLUMNS])
    return solved.unionByName(walked.mapInArrow(
        trimmed(render), f"conv_id {kind}, turn {turn_kind}, source_role string, piece int, role string, action string, rendered string"))


def _arrow(turns: DataFrame, names: list[str]) -> pa.Schema:
    kinds = {"part": pa.int32(), "at": pa.int64(), "border": pa.bool_(), "piece": pa.int32()}
    for c in ("conv_id", "turn"):
        kinds[c] = to_arrow_type(turns.schema[c].dataType)
    return pa.schema([(n, kinds.get(n, pa.string())) for n in names])


ORACLE = """
WITH RECURSIVE t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 WHEN 'assistant' THEN 3 ELSE 0 END AS r FROM conversations),
f AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS c0, 1000000000 AS c1, 1000000000 AS c2, 1000000000 AS c3 FROM t
  UNION ALL
  SELECT t.conv_id, t.i, 1000000000, least(c0, c1 + 2, 999999999) + 3 * (r <> 1)::INTEGER,
         least(c0, c1, c2 + 2, c3, 999999999) + 3 * (r <> 2)::INTEGER,
         least(c0 + 4, c1 + 4, c2, c3 + 2, 999999999) + 3 * (r <> 3)::INTEGER
  FROM f JOIN t ON t.conv_id = f.conv_id AND t.i = f.i + 1),
b AS (SELECT t.conv_id, t.i, CASE WHEN c1 + 8 <= least(c2 + 4, c3) THEN 1 WHEN c2 + 4 <= c3 THEN 2 ELSE 3 END AS now
  FROM f JOIN t USING (conv_id, i) WHERE i = n
  UNION ALL
  SELECT f.conv_id, f.i, CASE
    WHEN now = 1 THEN CASE WHEN c0 <= c1 + 2 THEN 0 ELSE 1 END
    WHEN now = 2 THEN CASE WHEN c0 <= least(c1, c2 + 2, c3) THEN 0 WHEN c1 <= least(c2 + 2, c3) THEN 1 WHEN c2 + 2 <= c3 THEN 2 ELSE 3 END
    ELSE CASE WHEN c0 + 4 <= least(c1 + 4, c2, c3 + 2) THEN 0 WHEN c1 + 4 <= least(c2, c3 + 2) THEN 1 WHEN c2 <= c3 + 2 THEN 2 ELSE 3 END END
  FROM b JOIN f ON f.conv_id = b.conv_id AND f.i = b.i - 1),
s AS (SELECT t.*, b.now, p.now AS was, t.i = t.n AS final, b.now = 3 AND p.now IN (0, 1) AS pre, b.now = p.now AS merged,
        ['system', 'user', 'assistant'][b.now] AS own,
        replace(replace(coalesce(text, ''), '<|im_start|>', '<' || chr(8205) || '|im_start|>'),
                '<|im_end|>', '<' || chr(8205) || '|im_end|>') AS safe,
        CASE WHEN p.now = 0 THEN '' ELSE '<|im_end|>' || chr(10) END AS shut
      FROM t JOIN b USING (conv_id, i) JOIN b p ON p.conv_id = t.conv_id AND p.i = t.i - 1),
x AS (
  SELECT conv_id, turn, role AS source_role, 0 AS piece, 'user' AS role, 'insert' AS action,
         shut || '<|im_start|>user' || chr(10) AS rendered FROM s WHERE pre
  UNION ALL
  SELECT conv_id, turn, role, pre::INTEGER, own,
         CASE WHEN r = now THEN CASE WHEN merged THEN 'merge' ELSE 'keep' END WHEN merged THEN 'relabel+merge' ELSE 'relabel' END,
         CASE WHEN merged THEN chr(10) || safe
              ELSE (CASE WHEN pre THEN '<|im_end|>' || chr(10) ELSE shut END) || '<|im_start|>' || own || chr(10) || safe END
         || CASE WHEN final AND now = 3 THEN '<|im_end|>' || chr(10) ELSE '' END FROM s
  UNION ALL
  SELECT conv_id, turn, role, pre::INTEGER + 1, 'user', 'insert', '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10)
  FROM s WHERE final AND now = 1
  UNION ALL
  SELECT conv_id, turn, role, pre::INTEGER + 3 - now, 'assistant', 'insert',
         '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<|im_end|>' || chr(10) FROM s WHERE final AND now IN (1, 2))
SELECT conv_id, turn, source_role, piece::INTEGER AS piece, role, action, sha256(rendered) AS rendered_sha256,
       length(rendered)::INTEGER AS n_chars FROM x
"""
