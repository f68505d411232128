"""Repair of conversations by weighted finite-state composition.

The rows of a conversation are an input acceptor, the edits (keep K, rerole R, delete D, insert I) a transducer with costs,
and the roles that may follow one another, ``(s?(ua)+)?`` by their initials, an acceptor of four states. Composed, a state is
a place in the conversation, the inserts made there (two lead from any state to any other that is worth reaching, so the
machine has no circle) and a grammar state. Nothing of it is built but what rows need: ``arcs`` expands the arcs of one kind
of row from one grammar state when a row of that kind is first met. Weights are (cost, label string), compared in that order.
Arcs from one state have labels of which none is a prefix of another, and a label leads to one state only, so the least
label string is decided arc by arc: the shortest path goes backward in topological order, the labels are read off forward.

Scale: a conversation may hold any share of all rows. Rows are dealt by ranges of (conversation, turn, role, text), so a long
one lies in many tasks, and are cut into chunks of at most 4,096 rows. A chunk's costs between grammar states are a small
matrix; scans over a conversation's matrices give the costs behind each chunk and then the state in which the path enters
it, and each chunk finds its own edits. Copies of a row are one row with a number, combined before the shuffle. Only
``digests``, whose hash is by nature sequential, reads a conversation in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nimbria.llm.common import cut, small_batches, strings, written

REROLE, DELETE, INSERT, TRUNCATED, CHUNK_BITS = 3, 4, 3, 3, 12
FAR = 1 << 60
#: Grammar ``(s?(ua)+)?``: next state by initial of the role; the path may end in state 0 or 3.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: From each state what can be inserted or reroled to, and the cost and edits that end a conversation there.
MADE = ("u", "u", "a", "u")
ENDS = ((0, "", ""), (2 * INSERT, "II", "ua"), (INSERT, "I", "a"), (0, "", ""))
ROLES = {"u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\x0c\r"

Arc = tuple[int, int, str, str]


@lru_cache(maxsize=256)
def arcs(initial: str, fault: str, state: int) -> tuple[Arc, ...]:
    """(next state, cost, label, initials made) of the ways to take one row from a grammar state, inserts before it
    included; of several ways to one state only the least (cost, label)."""
    best: dict[int, tuple[int, str, str]] = {}
    at, cost, label, made = state, 0, "", ""
    for _ in range(3):
        ways = [(at, DELETE, "D", "")]
        if fault not in ("b", "d"):
            more = TRUNCATED if fault == "t" else 0
            if initial in GRAMMAR[at]:
                ways.append((GRAMMAR[at][initial], more, "K", initial))
            ways.append((GRAMMAR[at][MADE[at]], REROLE + more, "R", MADE[at]))
        for to, w, letter, role in ways:
            found = (cost + w, label + letter, made + role)
            if to not in best or found < best[to]:
                best[to] = found
        made, at, cost, label = made + MADE[at], GRAMMAR[at][MADE[at]], cost + INSERT, label + "I"
    return tuple((to, *w) for to, w in best.items())


def costs(marks: list[tuple[str, str]]) -> list[int]:
    """The least costs of a chunk from each grammar state to each, as 16 numbers."""
    total = [[0 if g == t else FAR for t in range(4)] for g in range(4)]
    for initial, fault in reversed(marks):
        total = [[min(FAR, *(w + total[to][t] for to, w, _, _ in arcs(initial, fault, g))) for t in range(4)] for g in range(4)]
    return [c for row in total for c in row]


def choices(marks: list[tuple[str, str]], after: list[int]) -> list[list[Arc]]:
    """For each row and grammar state the arc of the shortest path, given the costs behind the chunk."""
    chosen = []
    for initial, fault in reversed(marks):
        step = [min(arcs(initial, fault, g), key=lambda a: (a[1] + after[a[0]], a[2])) for g in range(4)]
        after = [w + after[to] for to, w, _, _ in step]
        chosen.append(step)
    return chosen[::-1]


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, times) after damage by the checksum of ``conv_id:turn`` modulo 20.

    0 drops the row (``times`` 0), 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats it (``times`` 2), 4 makes its
    role user. Nulls read as one space, in the checksum too; ``conv_id`` and ``turn`` themselves stay null.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    kind, text = F.crc32(key.cast("binary")) % 20, F.coalesce(F.col(text_col), space)
    return conversations.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col(role_col), space)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("times"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, first fault and place (ordered within and over tasks), written."""
    live = F.col("times") > 0
    rows = rows.select("conv_id", F.when(live, F.col("turn")).alias("turn"), F.when(live, F.col("role")).alias("role"), F.when(live, F.col("text")).alias("text"), "times")
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    seen = rows.where(live).groupBy("conv_id", "role", "h", "h2").agg(F.min(order).alias("first"), F.count("*").alias("held")).where("held > 1").drop("held")
    keys = ["conv_id", "role", "h", "h2"]
    seen = seen.select(*(F.col(c).alias(f"seen_{c}") for c in keys), "first")
    rows = rows.join(seen, [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in keys], "left")
    shown = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(shown == "", "b").when(order > F.col("first"), "d").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "t").otherwise("")
    rows = rows.select("conv_id", "turn", "role", "text", "times", fault.alias("fault"), F.substring("text", 1, 64).alias("start"))
    by = ["conv_id", "turn", "role", "start"]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("pos", F.monotonically_increasing_id())
    return written(dealt.drop("start"), "dialogue")


def _scan(df: DataFrame, column: str, descending: bool, schema: str, start: Callable[[], list], step: Callable[[list, list], tuple[list, list]]) -> DataFrame:
    """A fold over each conversation's chunks in order: ``step`` of what is carried and the chunk's ``column`` gives what is
    noted for the chunk and what is carried on. One number array a chunk is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, carried = object(), []
        for batch in batches:
            noted = []
            for conv, value in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if conv != own:
                    own, carried = conv, start()
                note, carried = step(carried, value)
                noted.append(note)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(noted, pa.list_(pa.int64()))], names=["chunk", "noted"])

    ordered = df.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk") if descending else F.asc("chunk"))
    return ordered.select("conv_id", "chunk", column).mapInArrow(run, schema)


def _marks(column: pa.Array) -> list[list[tuple[str, str]]]:
    return [[(m["initial"], m["fault"]) for m in marks] for marks in column.to_pylist()]


def repair(rows: DataFrame) -> DataFrame:
    """The cheapest edits of conversations that make their roles ``(s?(ua)+)?``; ties go to the ASCII-least letters.

    ``rows`` has conv_id, turn, role (string), text and optionally ``times``, how often the row stands there one after the
    other (0: the row is gone, and only its conversation is still reported). A conversation's rows are ordered by turn (nulls
    first), then role and text. A row is blank (b: no character but ``[\\x20\\x09-\\x0D]``), else duplicate (d: role and text
    were seen before in its conversation), else truncated (t: its last such character is not one of ``.!?``). K costs 0, R (to
    user or assistant) 3, D 4, and blank and duplicate rows must go; I (a row of empty text before or after) costs 3, and a
    truncated row that stays 3 more. Texts stay as they are.

    Returns (conv_id, pos, turn, role, text, times, fault, edit, made, tail, tail_made): ``pos`` orders all rows of a
    conversation. ``edit`` are the letters up to and with the row's own, ``made`` the initials of the roles that they leave
    (the row's own for K); each of the other ``times - 1`` copies is deleted after it; ``tail`` are inserts at the end of the
    conversation. A conversation without rows has one row with ``times`` 0 and empty edits.

    Null roles or texts: fill them before (``damage`` makes them one space); they are read as empty. An empty role or one of
    another initial fits no place and cannot be kept. A null conv_id is a conversation of its own. Repeated rows are copies.
    An empty table gives an empty result; other columns are left out, whatever their names. Bytes that are no UTF-8 stay.
    """
    if "times" not in rows.columns:
        rows = rows.withColumn("times", F.lit(1).cast("long"))
    filled = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    placed = _placed(rows.select("conv_id", "turn", *filled, F.col("times").cast("long").alias("times")))
    mark = F.struct("pos", F.substring("role", 1, 1).alias("initial"), "fault")
    block = F.shiftright("pos", CHUNK_BITS).alias("block")
    chunks = placed.where("times > 0").groupBy("conv_id", block).agg(F.array_sort(F.collect_list(mark)).alias("marks"))
    chunks = cut(chunks.withColumn("chunk", F.col("marks")[0]["pos"]).drop("block"))
    kind = placed.schema["conv_id"].dataType.simpleString()

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [costs(m) for m in _marks(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "chunk", "costs"])

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for marks, after in zip(_marks(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                at = list(range(4))
                for step in choices(marks, after):
                    at = [step[g][0] for g in at]
                found.append(at)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["conv_id", "chunk", "exits"])

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for marks, after, entry in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                g, last = entry[0], entry[1]
                for m, step in zip(marks, choices([(m["initial"], m["fault"]) for m in marks], after), strict=True):
                    g, _, label, made = step[g]
                    out.append((m["pos"], label, made, "", ""))
                if last:
                    out[-1] = (*out[-1][:3], *ENDS[g][1:])
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i else pa.int64()) for i, c in enumerate(columns)], names=["pos", "edit", "made", "tail", "tail_made"])

    def backward(after: list, matrix: list) -> tuple[list, list]:
        ahead = [min(FAR, *(matrix[4 * g + t] + after[t] for t in range(4))) for g in range(4)]
        return after[:5], [*ahead, 0]  # the fifth number tells the last chunk

    def forward(state: list, onward: list) -> tuple[list, list]:
        return state, [onward[state[0]]]

    small_batches(chunks, 1 << 20)
    found = chunks.select("conv_id", "chunk", "marks").mapInArrow(matrices, f"conv_id {kind}, chunk bigint, costs array<bigint>")
    ends = _scan(found, "costs", True, "chunk bigint, noted array<bigint>", lambda: [e[0] for e in ENDS] + [1], backward)
    known = cut(chunks.join(ends.withColumnRenamed("noted", "after"), "chunk"))
    onward = known.select("conv_id", "chunk", "marks", "after").mapInArrow(exits, f"conv_id {kind}, chunk bigint, exits array<bigint>")
    entries = _scan(onward, "exits", False, "chunk bigint, noted array<bigint>", lambda: [0], forward)
    entered = known.join(entries, "chunk").select("marks", "after", F.array(F.col("noted")[0], F.col("after")[4]).alias("entry"))
    edited = entered.mapInArrow(edits, "pos bigint, edit string, made string, tail string, tail_made string")
    return placed.join(edited, "pos", "left").fillna("", ["role", "text", "fault", "edit", "made", "tail", "tail_made"])


def _letters(edit: str, made: str) -> Column:
    """The letters of an edit string that leave a row, with the initial of its role: (letter, initial)."""
    kept = F.filter(F.split(F.col(edit), ""), lambda x: ~x.isin("D", ""))
    return F.transform(kept, lambda x, i: F.struct(x.alias("letter"), F.substring(F.col(made), i + 1, F.lit(1)).alias("initial")))


def repaired(edited: DataFrame) -> DataFrame:
    """(conv_id, pos, place, edit, role, text): the rows that the edits leave or insert; (pos, place) orders them."""
    rows = edited.select("conv_id", "pos", "role", "text", F.posexplode(F.concat(_letters("edit", "made"), _letters("tail", "tail_made"))).alias("place", "x"))
    role = F.when(F.col("x.letter") == "K", F.col("role")).when(F.col("x.initial") == "u", "user").otherwise("assistant")
    text = F.when(F.col("x.letter") == "I", "").otherwise(F.col("text"))
    return rows.select("conv_id", "pos", "place", F.col("x.letter").alias("edit"), role.alias("role"), text.alias("text"))


def digests(edited: DataFrame) -> DataFrame:
    """One row a conversation of ``repair``'s result: gaps, blank, duplicate, truncated, illegal, cost (long), audit (all
    letters) and repaired_sha256, the hash of the ``role:text`` that are left, joined by line feeds.

    A conversation is read as a stream in one task, since its hash is sequential; what is held is its letters and one row.
    """
    kind = edited.schema["conv_id"].dataType.simpleString()
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = f"conv_id {kind}, {', '.join(f'{n} bigint' for n in numbers)}, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: object = run
        state: dict = {}

        def fresh() -> dict:
            return {**dict.fromkeys(numbers, 0), "turns": [], "last": None, "audit": [], "hash": hashlib.sha256(), "rows": 0, "initial": None}

        def done() -> list:
            s, turns = state, state["turns"]
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            return [own, gaps, *(s[n] for n in numbers[1:]), "".join(s["audit"]), s["hash"].hexdigest()]

        def leave(role: str, text: str) -> None:
            state["hash"].update((b"\n" if state["rows"] else b"") + f"{role}:{text}".encode())
            state["rows"] += 1

        def take(turn: int | None, role: str, text: str, times: int, fault: str, edit: str, made: str, tail: str, tail_made: str) -> None:
            if turn is not None:
                turns = state["turns"]
                state["turns"] = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
            state["blank"] += times if fault == "b" else 0
            state["duplicate"] += times if fault == "d" else 0 if fault == "b" else times - 1
            state["truncated"] += fault == "t"
            state["illegal"] += times - 1 + (state["initial"] is not None and state["initial"] + role[:1] not in ("su", "ua", "au"))
            state["initial"] = role[:1]
            state["cost"] += DELETE * (times - 1) + sum({"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[x] for x in edit + tail)
            state["cost"] += TRUNCATED * (fault == "t" and edit[-1] != "D")
            state["audit"].append(edit + "D" * (times - 1) + tail)
            for letters, initials in ((edit, made), (tail, tail_made)):
                for letter, initial in zip((x for x in letters if x != "D"), initials, strict=True):
                    leave(role if letter == "K" else ROLES[initial], "" if letter == "I" else text)

        for batch in batches:
            out = []
            columns = [strings(c) if pa.types.is_string(c.type) else c.to_pylist() for c in batch.columns]
            for conv, *row in zip(*columns, strict=True):
                if own is run or conv != own:
                    if own is not run:
                        out.append(done())
                    own, state = conv, fresh()
                if row[3]:
                    take(*row)
            yield _batch(out, schema_types(batch.column(0).type))
            conv_type = batch.column(0).type
        if own is not run:
            yield _batch([done()], schema_types(conv_type))

    def schema_types(conv: pa.DataType) -> pa.Schema:
        return pa.schema([("conv_id", conv), *((n, pa.int64()) for n in numbers), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def _batch(rows: list, kinds: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types, strict=True)], names=kinds.names)

    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    ordered = ordered.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", "times", "fault", "edit", "made", "tail", "tail_made")
    return small_batches(ordered).mapInArrow(run, schema)


REPAIR_SQL = r"""
WITH RECURSIVE bits(c, step, v) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) AS t(i)
  UNION ALL
  SELECT c, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY c) AS t FROM bits WHERE step = 8),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS x
  FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(x), 2), lambda i: CAST('0x' || x[i : i + 1] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS k
  FROM source, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS t(copy) WHERE k <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS shown FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM ordered),
rows_ AS MATERIALIZED (
  SELECT *, left(role, 1) AS c, CASE WHEN shown = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM seen),
counts AS MATERIALIZED (
  SELECT conv_id, count(*) AS m, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_ GROUP BY conv_id),
walk(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, m, {'w': CAST(0 AS BIGINT), 'l': ''}, {'w': CAST(6 AS BIGINT), 'l': 'II'}, {'w': CAST(3 AS BIGINT), 'l': 'I'}, {'w': CAST(0 AS BIGINT), 'l': ''} FROM counts
  UNION ALL
  SELECT conv_id, i - 1,
    list_min([b0, {'w': b2.w + 3, 'l': 'I' || b2.l}, {'w': b3.w + 6, 'l': 'II' || b3.l}]), list_min([b1, {'w': b2.w + 3, 'l': 'I' || b2.l}, {'w': b3.w + 6, 'l': 'II' || b3.l}]),
    list_min([b2, {'w': b3.w + 3, 'l': 'I' || b3.l}, {'w': b2.w + 6, 'l': 'II' || b2.l}]), list_min([b3, {'w': b2.w + 3, 'l': 'I' || b2.l}, {'w': b3.w + 6, 'l': 'II' || b3.l}])
  FROM (
    SELECT w.conv_id, w.i,
      list_min([{'w': v0.w + 4, 'l': 'D' || v0.l}, {'w': v2.w + 3 + t, 'l': 'R' || v2.l}, {'w': CASE c WHEN 's' THEN v1.w + t WHEN 'u' THEN v2.w + t ELSE 1000000000 END, 'l': 'K' || CASE c WHEN 's' THEN v1.l ELSE v2.l END}]) AS b0,
      list_min([{'w': v1.w + 4, 'l': 'D' || v1.l}, {'w': v2.w + 3 + t, 'l': 'R' || v2.l}, {'w': CASE c WHEN 'u' THEN v2.w + t ELSE 1000000000 END, 'l': 'K' || v2.l}]) AS b1,
      list_min([{'w': v2.w + 4, 'l': 'D' || v2.l}, {'w': v3.w + 3 + t, 'l': 'R' || v3.l}, {'w': CASE c WHEN 'a' THEN v3.w + t ELSE 1000000000 END, 'l': 'K' || v3.l}]) AS b2,
      list_min([{'w': v3.w + 4, 'l': 'D' || v3.l}, {'w': v2.w + 3 + t, 'l': 'R' || v2.l}, {'w': CASE c WHEN 'u' THEN v2.w + t ELSE 1000000000 END, 'l': 'K' || v2.l}]) AS b3
    FROM walk w JOIN (SELECT conv_id, i, c, CASE fault WHEN 't' THEN 3 WHEN '' THEN 0 ELSE 1000000000 END AS t FROM rows_) r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.i = r.i)),
best AS MATERIALIZED (SELECT conv_id, v0.w AS cost, v0.l AS audit FROM walk WHERE i = 0),
letters AS (
  SELECT conv_id, j, audit[j] AS e, length(replace(audit[: j], 'I', '')) AS i, length(replace(audit[: j], 'D', '')) AS nth, length(replace(audit, 'D', '')) % 2 AS odd
  FROM best, unnest(range(1, length(audit) + 1)) AS t(j)),
lines AS (
  SELECT l.conv_id, l.j, CASE WHEN e = 'K' THEN r.role WHEN l.nth % 2 = 1 - odd THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE r.text END AS line
  FROM letters l LEFT JOIN rows_ r ON l.conv_id IS NOT DISTINCT FROM r.conv_id AND l.i = r.i WHERE e <> 'D'),
hashed AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS digest FROM lines GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(c.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN hashed h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""
