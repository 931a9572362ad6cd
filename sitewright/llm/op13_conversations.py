"""Conversation structure repair: the cheapest edits by Hirschberg's divide and conquer over four states.

The rows of a conversation are to have roles whose initials read `(s?(ua)+)?`. An
automaton of four states reads them: START, SYSTEM, USER and ASSISTANT, of which
START and ASSISTANT may be the last. Edits are Keep (0), Rerole to user or
assistant (3), Delete (4) and Insert of an empty user or assistant row (3);
blank rows and repeated ones must go, and a row whose text breaks off adds 3 if it
stays. Of the cheapest edits those whose initials D, I, K, R read least are taken.

Half of the rows are read forward from the first state, which gives the least
cost of every state in the middle, and how the least edits that lead there
compare; the other half backward from the last states. The states where both sums
are least are the optimal crossings; the one reached by the least edits is taken,
and both halves are solved alike. No table of all rows is kept: a row is one byte.

Rows are narrow when they are ordered: equal ones are counted first, texts are
named by MD5. They are dealt by ranges of (conversation, turn, role, text), so
that a large conversation is spread over tasks, and packed into segments of at most
SEGMENT rows. A segment's cost from every state to every state is a 4 x 4 matrix;
the matrices of a conversation, read from its end, give the least costs from the end
of every segment on. With these, every segment is solved by itself, from each
state that it may begin in, and one short pass over the segments chooses.

Only the digest of a conversation, and its audit as one string, take its rows in
order in one task, which streams them.

Defined results: a null role or text is one space; rows of a conversation go by
turn, nulls first, then by role and by the text's MD5; rows with a null conv_id are
one conversation; a role that begins with none of s, u, a can only be reroled or
deleted; other columns are ignored. No conversations give no rows.
"""

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.sources.files import staged

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row with this initial leads to, by state.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The row that can be made or put in at each state, and the state after it.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LAST = (0, None, None, 0)
RENAME, DROP, PUT, BROKEN = 3, 4, 3, 3
#: Rows of a segment.
SEGMENT = 16_384
#: A row as one byte: its initial's number, and 4 times its fault's.
INITIALS = "sua?"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
WHITE = r"[\x20\x09-\x0D]"
INFINITE = 1 << 60

PACKED = (
    "conv_id long, seq long, codes binary, first_turn long, last_turn long, turns long, costs array<long>"
)


# -- The edits of a run of rows ------------------------------------------------------------------------------------------------


def _steps(code: int, state: int) -> list[tuple[str, int, int]]:
    """Edits of a row in a state: initial, cost and state after it."""
    fault, initial = code >> 2, INITIALS[code & 3]
    out = [("D", DROP, state)]
    if fault in (FINE, TRUNCATED):
        more = BROKEN if fault == TRUNCATED else 0
        if state in AFTER.get(initial, {}):
            out.append(("K", more, AFTER[initial][state]))
        out.append(("R", RENAME + more, NEXT[state]))
    return out


STEPS = [[_steps(code, state) for state in range(4)] for code in range(16)]
#: From each state the states that up to three inserts lead to, with their number.
INSERTS = [[(state, 0), (a := NEXT[state], 1), (b := NEXT[a], 2), (NEXT[b], 3)] for state in range(4)]


def forward(codes: bytes, states: list) -> list:
    """For each state what leads there over the rows: None, or (cost, order, inserts at the end).

    Lists of edits that end with a row's edit are told apart by `order`, 0 being the least;
    edits that differ in their last inserts only have the same.
    """
    states = _put(states)
    for code in codes:
        found: list = [None] * 4
        for state, known in enumerate(states):
            if known is not None:
                cost, order, inserts = known
                for initial, price, to in STEPS[code][state]:
                    new = (cost + price, order, "I" * inserts + initial)
                    if found[to] is None or new < found[to]:
                        found[to] = new
        orders = {key: i for i, key in enumerate(sorted({x[1:] for x in found if x is not None}))}
        states = _put([None if x is None else (x[0], orders[x[1:]], 0) for x in found])
    return states


def _put(states: list) -> list:
    out = list(states)
    for state, known in enumerate(states):
        if known is not None:
            for to, n in INSERTS[state][1:]:
                new = (known[0] + n * PUT, known[1], known[2] + n)
                if out[to] is None or new < out[to]:
                    out[to] = new
    return out


def backward(codes: bytes, ends: list) -> list:
    """The least cost from each state over the rows, given what each state costs after them (None: not allowed)."""
    after = _before_inserts([INFINITE if x is None else x for x in ends])
    for code in reversed(codes):
        steps = STEPS[code]
        after = _before_inserts([min(price + after[to] for _, price, to in steps[state]) for state in range(4)])
    return after


def _before_inserts(costs: list[int]) -> list[int]:
    return [min(n * PUT + costs[to] for to, n in INSERTS[state]) for state in range(4)]


def edits(codes: bytes, state: int, ends: list) -> tuple[str, int]:
    """Initials of the least of the cheapest edits of rows from a state on, and the last state."""
    out: list[str] = []
    todo: list[tuple[int, int, list]] = [(0, len(codes), ends)]
    while todo:
        low, high, ends = todo.pop()
        if high - low <= 1:
            text, state = _single(codes[low:high], state, ends)
            out.append(text)
            continue
        middle = (low + high) // 2
        first = [None] * 4
        first[state] = (0, 0, 0)
        reached, rest = forward(codes[low:middle], first), backward(codes[middle:high], ends)
        _, _, _, crossing = min((x[0] + rest[q], x[1], x[2], q) for q, x in enumerate(reached) if x is not None)
        through: list = [None] * 4
        through[crossing] = 0
        todo += [(middle, high, ends), (low, middle, through)]
    return "".join(out), state


def _single(codes: bytes, state: int, ends: list) -> tuple[str, int]:
    """The same for one row, or none, by trying all edits."""
    tries = [(n * PUT, "I" * n, to) for to, n in INSERTS[state]]
    for code in codes:
        tries = [(cost + price, text + initial, to) for cost, text, at in tries for initial, price, to in STEPS[code][at]]
        tries = [(cost + n * PUT, text + "I" * n, to) for cost, text, at in tries for to, n in INSERTS[at]]
    _, text, end = min((cost + ends[to], text, to) for cost, text, to in tries if ends[to] is not None and ends[to] < INFINITE)
    return text, end


def costs(codes: bytes) -> list[int]:
    """The least cost from each state to each, row by row of the matrix."""
    columns = []
    for end in range(4):
        ends: list = [None] * 4
        ends[end] = 0
        columns.append(backward(codes, ends))
    return [min(columns[end][state], INFINITE) for state in range(4) for end in range(4)]


def price(codes: bytes, audit: str) -> int:
    """What the edits cost."""
    rows, out = iter(codes), 0
    for initial in audit:
        code = None if initial == "I" else next(rows)
        out += PUT if code is None else DROP if initial == "D" else RENAME * (initial == "R") + BROKEN * (code >> 2 == TRUNCATED)
    return out


def replay(audit: Iterator[str], rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the rows after the edits."""
    state = START
    for initial in audit:
        role, text = ("", "") if initial == "I" else next(rows)
        if initial == "D":
            continue
        if initial == "K":
            state = AFTER[role[0]][state]
        else:
            state = NEXT[state]
            role = "user" if state == USER else "assistant"
        yield role, text


# -- Conversations -------------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with the faults to mend, and `lost` for rows that are there only to name their conversation."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
        (kind == 0).alias("lost"), F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("conv_id", "turn", "role", "text", "lost", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def _turns(conversations: DataFrame) -> DataFrame:
    lost = F.col("lost") if "lost" in conversations.columns else F.lit(False)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), lost.alias("lost"),
    )
    return rows.withColumn("key", F.md5("text"))


def coded(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, key, code and times of the rows (of _turns), equal ones once; a code is for the first of them."""
    bare = F.regexp_replace("text", WHITE + r"+\z", "")
    fault = F.when(bare == "", BLANK).when(~bare.rlike(r"[.!?]\z"), TRUNCATED).otherwise(FINE)
    rows = turns.where("NOT lost").select("conv_id", "turn", "role", "key", fault.alias("fault"))
    rows = staged(rows.groupBy("conv_id", "turn", "role", "key", "fault").agg(F.count(F.lit(1)).alias("times")), "turns-coded")
    # Texts that come in several turns of a conversation are faults in all but the first.
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = rows.groupBy("conv_id", "role", "key").agg(F.min(when).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k"), F.col("first.turn").alias("first"), F.lit(True).alias("more"))
    both = rows.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")), "left")
    late = F.col("more").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")) & (F.col("fault") != BLANK)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS[:3]))
    initial = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1)
    code = initial + 4 * F.when(late, DUPLICATE).otherwise(F.col("fault"))
    return both.select("conv_id", "turn", "role", "key", code.cast("int").alias("code"), "times")


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Rows of PACKED: conversations in segments, in the order of seq; `rows` are those of coded()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 32
        codes, turns = bytearray(), []
        conv: object = run  # no conversation
        out: list[tuple] = []

        def close():
            nonlocal seq
            if codes:
                seq += 1
                known = [t for t in turns if t is not None]
                ends = (known[0], known[-1]) if known else (None, None)
                out.append((conv, seq, bytes(codes), *ends, len(known), costs(codes)))
            codes.clear(), turns.clear()

        for batch in batches:
            for own, turn, code, times in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if own != conv or len(codes) >= segment:
                    close()
                    conv = own
                if turn is not None and (not turns or turns[-1] != turn):
                    turns.append(turn)
                codes.append(code)
                again = code & 3 | (BLANK if code >> 2 == BLANK else DUPLICATE) << 2
                for _ in range(times - 1):
                    if len(codes) >= segment:
                        close()
                    codes.append(again)
            if len(out) >= 1024:
                yield _batch(out, PACKED)
                out.clear()
        close()
        yield _batch(out, PACKED)

    parts = rows.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions("conv_id", "turn", "role", "key")
    return parts.select("conv_id", "turn", "code", "times").mapInArrow(run, PACKED)


_TYPES = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, types = zip(*(field.strip().split(" ") for field in schema.split(",")))
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(columns, types)], list(names))


def _stream(df: DataFrame, order: list, columns: list[str], schema: str, make: Callable) -> DataFrame:
    """All rows of a conversation in order through one function, which `make()` gives: (conv_id, rows) to rows of the schema."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import chain, groupby

        rows = chain.from_iterable(zip(*(b.column(i).to_pylist() for i in range(b.num_columns))) for b in batches)
        out: list[tuple] = []
        for conv, own in groupby(rows, key=lambda r: r[0]):
            for row in make(conv, own):
                out.append(row)
                if len(out) >= 1024:
                    yield _batch(out, schema)
                    out.clear()
        yield _batch(out, schema)

    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order).select(*columns).mapInArrow(run, schema)


def _ahead(conv, rows) -> Iterator[tuple]:
    """From the last segment to the first: what the states cost after each."""
    after = [INFINITE if x is None else x for x in LAST]
    held = None
    for _, seq, matrix in rows:
        if held is not None:
            yield (*held, 0)
        held = (conv, seq, after)
        after = [min(INFINITE, *(matrix[4 * state + end] + after[end] for end in range(4))) for state in range(4)]
    yield (*held, 1)


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for conv, seq, codes, ends, first in zip(*(batch.column(i).to_pylist() for i in range(5))):
            found = [edits(codes, state, ends) for state in ([START] if first else range(4))]
            out.append((conv, seq, [text for text, _ in found], [end for _, end in found]))
        yield _batch(out, "conv_id long, seq long, audits array<string>, states array<long>")


def _chosen(conv, rows) -> Iterator[tuple]:
    state = START
    for _, seq, audits, states in rows:
        at = 0 if len(audits) == 1 else state
        yield conv, seq, audits[at]
        state = states[at]


def repairs(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, seq, codes, first_turn, last_turn, turns and audit (initials of the edits) of every segment of coded() rows."""
    packed = staged(segments(rows, segment), "turns-packed")
    ahead = _stream(packed, [F.desc("seq")], ["conv_id", "seq", "costs"], "conv_id long, seq long, after array<long>, first long", _ahead)
    ahead = ahead.select("seq", "after", "first")  # seq names a segment by itself
    solved = packed.join(ahead, "seq").select("conv_id", "seq", "codes", "after", "first").mapInArrow(
        _solved, "conv_id long, seq long, audits array<string>, states array<long>"
    )
    chosen = _stream(solved, ["seq"], ["conv_id", "seq", "audits", "states"], "conv_id long, seq long, audit string", _chosen)
    return packed.drop("costs").join(chosen.select("seq", "audit"), "seq")


COUNTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _counted(conv, rows) -> Iterator[tuple]:
    blank = duplicate = truncated = illegal = cost = turns = 0
    first = last = before = None
    audits = []
    legal = [INITIALS.index(a) << 2 | INITIALS.index(b) for a, b in ("su", "ua", "au")]
    for _, _, codes, first_turn, last_turn, n, audit in rows:
        code = np.frombuffer(codes, dtype=np.uint8)
        faults, initials = np.bincount(code >> 2, minlength=4), code & 3
        blank, duplicate, truncated = blank + int(faults[BLANK]), duplicate + int(faults[DUPLICATE]), truncated + int(faults[TRUNCATED])
        joined = initials if before is None else np.r_[before, initials]
        illegal += int((~np.isin(joined[:-1].astype(np.int64) << 2 | joined[1:], legal)).sum())
        before = initials[-1]
        if n:
            turns += n - (last is not None and last == first_turn)
            first, last = (first_turn if first is None else first), last_turn
        cost += price(codes, audit)
        audits.append(audit)
    yield conv, (0 if first is None else last - first + 1 - turns), blank, duplicate, truncated, illegal, cost, "".join(audits)


def repaired(turns: DataFrame, audits: DataFrame, digest: bool = False) -> DataFrame:
    """conv_id, place (from 0), role and text of the repaired rows; or one row (conv_id, repaired_sha256) per conversation.

    `audits` has conv_id, seq and audit, in pieces or whole.
    """
    pieces = audits.select("conv_id", F.lit(0).alias("kind"), F.col("seq").alias("turn"), F.lit("").alias("role"), F.lit("").alias("key"), F.col("audit").alias("text"))
    rows = turns.where("NOT lost").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "key", "text")

    def mended(rows: Iterator[tuple]) -> Iterator[tuple[str, str]]:
        audit: list[str] = []
        for _, kind, role, text in rows:
            if kind:
                break
            audit.append(text)
        else:
            return replay(iter("".join(audit)), iter(()))

        def own():
            yield role, text
            for _, _, more, texts in rows:
                yield more, texts

        return replay(iter("".join(audit)), own())

    def each(conv, rows):
        for place, (role, text) in enumerate(mended(rows)):
            yield conv, place, role, text

    def hashed(conv, rows):
        state = hashlib.sha256()
        for place, (role, text) in enumerate(mended(rows)):
            state.update(("\n" * (place > 0) + role + ":" + text).encode())
        yield conv, state.hexdigest()

    schema = "conv_id long, repaired_sha256 string" if digest else "conv_id long, place long, role string, text string"
    return _stream(pieces.unionByName(rows), ["kind", "turn", "role", "key"], ["conv_id", "kind", "role", "text"], schema, hashed if digest else each)


def repair(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, place, role and text of the repaired rows of all conversations (conv_id, turn, role, text)."""
    turns = _turns(conversations)
    return repaired(turns, repairs(coded(turns), segment))


def report(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Every conv_id with its faults, the cost and initials of its edits and the digest of what they give.

    Rows marked `lost`, if there is such a column, only name their conversation.
    """
    turns = staged(_turns(conversations), "turns")
    pieces = staged(repairs(coded(turns), segment), "turns-audits")
    columns = ["conv_id", "seq", "codes", "first_turn", "last_turn", "turns", "audit"]
    counts = _stream(pieces, ["seq"], columns, COUNTS, _counted)
    digests = repaired(turns, pieces, digest=True)
    known = turns.select("conv_id").distinct()
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    both = known.alias("k").join(counts.alias("c"), F.col("k.conv_id").eqNullSafe(F.col("c.conv_id")), "left")
    both = both.join(digests.alias("d"), F.col("k.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    numbers = [F.coalesce(f"c.{x}", F.lit(0).cast("long")).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return both.select("k.conv_id", *numbers, F.coalesce("c.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", none).alias("repaired_sha256"))


def oracle() -> str:
    """DuckDB SQL for report(damaged(conversations)): all states with their least cost and edits, row by row."""

    def add(state: str, cost: str, initial: str) -> str:
        return f"(lpad((substr({state}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({state}, 13) || '{initial}')"

    kept = lambda *states: ", ".join(add(s, "m", "K") for s in states)
    made = lambda *states: ", ".join(add(s, "m + 3", "R") for s in states)
    bits = "c"
    for _ in range(8):
        bits = f"xor(({bits}) >> 1, 3988292384 * (({bits}) & 1))" if bits == "c" else f"list_transform([{bits}], lambda c: xor(c >> 1, 3988292384 * (c & 1)))[1]"
    return f"""
        WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda c: {bits}) AS t), c AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                    lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1])), 4294967295) % 20 AS kind
            FROM conversations, crc
        ), k AS (SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS conv, * FROM c), d AS (
            SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM k
        ), o AS (
            SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM d
        ), f AS (
            SELECT *, substr(role, 1, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) || substr(role, 1, 1) AS pair
            FROM o
        ), w AS (
            SELECT conv, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END::BIGINT AS gaps,
                count(*) FILTER (fault = 'blank')::BIGINT AS blank, count(*) FILTER (fault = 'duplicate')::BIGINT AS duplicate,
                count(*) FILTER (fault = 'truncated')::BIGINT AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, max(i) AS n
            FROM f GROUP BY conv
        ), r AS (
            SELECT conv, i, initial, fault IN ('', 'truncated') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS m FROM f
        ), s AS (
            SELECT conv, 0::BIGINT AS i, '000000000000' AS a, NULL::VARCHAR AS b, '000000000003I' AS c, '000000000006II' AS d FROM w
            UNION ALL
            SELECT conv, i, a, b, c, least(d, {add("c", "3", "I")}) FROM (
                SELECT conv, i, a, b, least(c, {add("a", "3", "I")}, {add("b", "3", "I")}, {add("d", "3", "I")}) AS c, d FROM (
                    SELECT conv, r.i AS i, {add("a", "4", "D")} AS a,
                        least({add("b", "4", "D")}, CASE WHEN stays AND initial = 's' THEN {kept("a")} END) AS b,
                        least({add("c", "4", "D")}, CASE WHEN stays AND initial = 'u' THEN least({kept("a", "b", "d")}) END, CASE WHEN stays THEN least({made("a", "b", "d")}) END) AS c,
                        least({add("d", "4", "D")}, CASE WHEN stays AND initial = 'a' THEN {kept("c")} END, CASE WHEN stays THEN {made("c")} END) AS d
                    FROM s JOIN r USING (conv) WHERE r.i = s.i + 1
                )
            )
        ), e AS (
            SELECT conv, substr(least(a, d), 1, 12)::BIGINT AS cost, substr(least(a, d), 13) AS audit FROM s JOIN w USING (conv) WHERE s.i = w.n
        ), x AS (SELECT conv, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS pos FROM e), y AS (
            SELECT conv, edit, pos, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv ORDER BY pos) AS i, count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv ORDER BY pos) AS j FROM x
        ), z AS (
            SELECT conv, j, edit, role, text, max(CASE WHEN j = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv) AS lead
            FROM y JOIN f USING (conv, i) WHERE edit NOT IN ('D', 'I') UNION ALL
            SELECT conv, j, edit, '', '', NULL FROM y WHERE edit = 'I'
        ), l AS (SELECT conv, coalesce(max(lead), 0) AS lead FROM z GROUP BY conv), h AS (
            SELECT conv, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - l.lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY j)) AS digest
            FROM z JOIN l USING (conv) GROUP BY conv
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
            coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
        FROM (SELECT DISTINCT conv, conv_id FROM k) LEFT JOIN w USING (conv) LEFT JOIN e USING (conv) LEFT JOIN h USING (conv)
    """
