"""Repair of conversations: the cheapest edits that make their turns alternate.

A repaired conversation reads as ``ROLES`` says: perhaps a system turn, then
user and assistant in turn, ending with the assistant; or it is empty. Each row
is kept, given another role or deleted, and empty turns are put in, at the
costs below. Blank rows and rows whose role and text came earlier in the
conversation are deleted.

The least costs follow a Viterbi lattice of rows and four states. Conversations
are cut into chunks of ``SPAN`` rows that are worked on in parallel, from the
end to the start: each chunk starts from a guess of the costs after it. The
costs that a chunk hands on are compared with what the chunk before had
guessed; where the two differ by more than a constant, that chunk runs again
from the real costs, until no chunk has to. Chunks on which this does not settle
in ``FIXUPS`` passes, such as long stretches of deleted rows, get exact costs
from products of their cost matrices, twice as many chunks in each step.
With all costs known the edits are traced from the start, first letter first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camlytics.llm.common import running, stored

#: Initials of the roles of a repaired conversation.
ROLES = "(s?(ua)+)?"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPAN = 256
FIXUPS = 4
#: Rows whose lines are put together before a conversation's digest reads them.
LINES = 16
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

# States: nothing yet, after the system, after a user, after an assistant.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = np.array([_USER, _USER, _ASSISTANT, _USER])
#: State after keeping a row with this initial (s, u, a, other), or -1.
_KEPT = np.array([
    [_SYSTEM, -1, -1, -1], [_USER, _USER, -1, _USER], [-1, -1, _ASSISTANT, -1], [-1, -1, -1, -1],
])
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: Codes of rows: 0 to 3 by initial, 4 more if truncated, and rows that have to go.
_GONE = 8
#: Costs of the states after the last row: what has to be put in.
_END = np.array([0, 2 * INSERT, INSERT, 0])
_NEVER = 1 << 20
_COSTS = T.ArrayType(T.IntegerType())


# --- the lattice, many chunks at a time ------------------------------------------


def _back(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before a row of each chunk, by state, from the costs after it."""
    gone = codes == _GONE
    code = np.where(gone, 0, codes)
    extra = np.where(code >= 4, TRUNCATED, 0)[:, None]
    kept = _KEPT[code % 4]
    keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), axis=1) + KEEP + extra, _NEVER)
    costs = np.minimum(np.minimum(after + DELETE, keep), after[:, _NEXT] + REROLE + extra)
    user = np.minimum(costs[:, _USER], costs[:, _ASSISTANT] + INSERT)
    costs[:, _ASSISTANT] = np.minimum(costs[:, _ASSISTANT], costs[:, _USER] + INSERT)
    costs[:, _USER] = user
    costs[:, :_USER] = np.minimum(costs[:, :_USER], user[:, None] + INSERT)
    return np.where(gone[:, None], after + DELETE, costs)


def _all_costs(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before every row and at the end: chunk, row, state."""
    out = np.empty((*codes.shape, 4), dtype=np.int64)
    out = np.concatenate([out, after[:, None, :]], axis=1)
    for row in range(codes.shape[1] - 1, -1, -1):
        out[:, row] = _back(codes[:, row], out[:, row + 1])
    return out


def _before(codes: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs before the first row of each chunk, less the smallest."""
    for row in range(codes.shape[1] - 1, -1, -1):
        after = _back(codes[:, row], after)
    return after - after.min(axis=1, keepdims=True)


def _insert(costs: np.ndarray, state: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Where the open chunks put in a turn before going on: no other way is as cheap."""
    here = np.take_along_axis(costs, state[:, None], axis=1)[:, 0]
    there = np.take_along_axis(costs, _NEXT[state][:, None], axis=1)[:, 0]
    return open_ & (there + INSERT == here)


def _trace(codes: np.ndarray, costs: np.ndarray, state: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of each chunk's rows, turns put in before each row (and at the end of the last chunk), state after it.

    Of equally cheap edits the first letter in ASCII order goes first, row by
    row: D, then I, K and R. Each letter has one outcome in each state, so this
    gives the least string.
    """
    chunks, rows = codes.shape
    letters = np.zeros((chunks, rows), dtype="U1")
    put = np.zeros((chunks, rows + 1), dtype=np.int64)
    each = np.arange(chunks)
    for row in range(rows):
        code = codes[:, row]
        gone = code == _GONE
        extra = np.where(code % _GONE >= 4, TRUNCATED, 0)
        pending = np.ones(chunks, dtype=bool)
        while pending.any():
            now = costs[each, row, state]
            delete = pending & (gone | (costs[each, row + 1, state] + DELETE == now))
            letters[delete, row] = "D"
            pending &= ~delete
            put_in = _insert(costs[:, row], state, pending)
            put[put_in, row] += 1
            kept = _KEPT[np.where(gone, 0, code) % 4, state]
            keep = pending & ~put_in & (kept >= 0)
            keep &= costs[each, row + 1, np.maximum(kept, 0)] + KEEP + extra == now
            rerole = pending & ~put_in & ~keep
            letters[keep, row] = "K"
            letters[rerole, row] = "R"
            state = np.where(keep, kept, np.where(put_in | rerole, _NEXT[state], state))
            pending &= put_in
    while True:
        put_in = _insert(costs[:, rows], state, last)
        if not put_in.any():
            return letters, put, state
        put[put_in, rows] += 1
        state = np.where(put_in, _NEXT[state], state)


def _padded(lists: pa.Array) -> np.ndarray:
    """Codes of each chunk, filled up at the end with rows that cost the same in all states."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(lists), max(int(sizes.max(initial=0)), 1)), -1, dtype=np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    out[out < 0] = _GONE
    return out


def _vectors(lists: pa.Array, width: int = 4) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _as_lists(values: np.ndarray) -> pa.Array:
    flat = values.reshape(len(values), -1)
    ends = np.arange(len(values) + 1) * flat.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.ravel(), pa.int32()))


@F.arrow_udf(_COSTS)
def _costs_before(codes: pa.Array, after: pa.Array) -> pa.Array:
    return _as_lists(_before(_padded(codes), _vectors(after)))


@F.arrow_udf(_COSTS)
def _cost_matrix(codes: pa.Array) -> pa.Array:
    """Costs from each state before the chunk to each state after it."""
    rows = _padded(codes)
    columns = []
    for state in range(4):
        after = np.full((len(rows), 4), _NEVER)
        after[:, state] = 0
        for row in range(rows.shape[1] - 1, -1, -1):
            after = np.minimum(_back(rows[:, row], after), _NEVER)
        columns.append(after)
    return _as_lists(np.stack(columns, axis=2))


@F.arrow_udf(_COSTS)
def _product(a: pa.Array, b: pa.Array) -> pa.Array:
    """Least costs over both chunks, less the smallest: only differences count."""
    x, y = _vectors(a, 16).reshape(-1, 4, 4), _vectors(b, 16).reshape(-1, 4, 4)
    both = np.minimum((x[:, :, :, None] + y[:, None, :, :]).min(axis=2), _NEVER)
    least = both.min(axis=(1, 2), keepdims=True)
    return _as_lists(np.where(both < _NEVER, both - least, _NEVER))


@F.arrow_udf(_COSTS)
def _applied(matrix: pa.Array) -> pa.Array:
    costs = (_vectors(matrix, 16).reshape(-1, 4, 4) + _END).min(axis=2)
    return _as_lists(costs - costs.min(axis=1, keepdims=True))


@F.arrow_udf(_COSTS)
def _exits(codes: pa.Array, after: pa.Array) -> pa.Array:
    """State after the chunk, for each state before it."""
    rows = _padded(codes)
    costs = _all_costs(rows, _vectors(after))
    inner = np.zeros(len(rows), dtype=bool)
    return _as_lists(np.stack([_trace(rows, costs, np.full(len(rows), q), inner)[2] for q in range(4)], axis=1))


_EDITS = T.StructType([
    T.StructField("letters", T.ArrayType(T.StringType())), T.StructField("put", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("roles", T.ArrayType(T.StringType())), T.StructField("cost", T.LongType()),
])


@F.arrow_udf(_EDITS)
def _edits(codes: pa.Array, after: pa.Array, state: pa.Array, last: pa.Array) -> pa.Array:
    """Letters of the chunk's rows, roles put in before each row and at the end, new roles, cost of the lattice's edits."""
    rows = _padded(codes)
    sizes = np.diff(codes.offsets.to_numpy())
    entered = state.to_numpy(zero_copy_only=False)
    is_last = np.asarray(last).astype(bool)
    letters, put, _ = _trace(rows, _all_costs(rows, _vectors(after)), entered, is_last)
    out = []
    for chunk, size in enumerate(sizes.tolist()):
        at, names, roles, cost = int(entered[chunk]), [], [], 0
        for row in [*range(size), rows.shape[1]]:
            inserted = []
            for _ in range(int(put[chunk, row])):
                at = int(_NEXT[at])
                inserted.append(_NAMES[at])
            names.append(inserted)
            cost += INSERT * len(inserted)
            if row == rows.shape[1]:
                break
            letter, code = letters[chunk, row], int(rows[chunk, row])
            if letter == "K":
                at = int(_KEPT[code % 4, at])
            elif letter == "R":
                at = int(_NEXT[at])
            roles.append(_NAMES[at] if letter == "R" else None)
            cost += DELETE if letter == "D" else (REROLE if letter == "R" else KEEP) + (TRUNCATED if code >= 4 else 0)
        out.append({"letters": letters[chunk, :size].tolist(), "put": names, "roles": roles, "cost": cost})
    return pa.array(out, type=pa.struct([
        ("letters", pa.list_(pa.string())), ("put", pa.list_(pa.list_(pa.string()))), ("roles", pa.list_(pa.string())), ("cost", pa.int64()),
    ]))


# --- rows and chunks -----------------------------------------------------------------


def _key(conv_id: Column) -> Column:
    """A name of the conversation that is never null."""
    return F.when(conv_id.isNull(), "-").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _rows(turns: DataFrame) -> DataFrame:
    """_conv, turn, role, text, n: equal rows of one turn as one, with their number."""
    return turns.select(
        _key(F.col("conv_id")).alias("_conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).groupBy("_conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))


def _faults(turns: DataFrame, span: int) -> DataFrame:
    """Rows in order (``_rank`` in the conversation, ``_chunk``) with initial, code and faults."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    ranked = stored(running(_rows(turns), order, "n", "turns", "_conv").drop("_before", "_all"), "ranked")
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    # Only the name of a text goes to the comparison; equal rows of one turn were one row already.
    seen = ranked.where(solid != "").groupBy("_conv", "role", F.sha2("text", 256).alias("_text")).agg(F.min("_rank").alias("_rank"))
    first = seen.select("_conv", "_rank", F.lit(True).alias("_first"))
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial)
    blank = solid == ""
    flagged = ranked.join(first, ["_conv", "_rank"], "left").select(
        "*", blank.alias("_blank"), (~blank & F.col("_first").isNull()).alias("_again"),
        (F.col("_first").isNotNull() & ~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("_open"),
        initial.cast("int").alias("_initial"), F.floor(F.col("_rank") / span).cast("long").alias("_chunk"),
    )
    code = F.when(F.col("_first").isNull(), _GONE).otherwise(F.col("_initial") + F.when(F.col("_open"), 4).otherwise(0))
    return stored(flagged.withColumn("_code", code.cast("int")), "faults")


def _chunks(rows: DataFrame) -> DataFrame:
    """One row per chunk: its codes in order, and whether it is the conversation's last."""
    listed = rows.groupBy("_conv", "_chunk").agg(F.sort_array(F.collect_list(F.struct("_rank", "_code"))).alias("_l"))
    last = rows.groupBy("_conv").agg(F.max("_chunk").alias("_last"))
    return stored(listed.join(last, "_conv").select(
        "_conv", "_chunk", (F.col("_chunk") == F.col("_last")).alias("_is_last"), F.col("_l")["_code"].alias("_codes"),
    ), "chunks")


_WHERE = ["_conv", "_chunk"]


def _shifted(df: DataFrame, by: int, **columns: str) -> DataFrame:
    """Columns of the chunk ``by`` places on, under new names."""
    return df.select("_conv", (F.col("_chunk") - by).alias("_chunk"), *[F.col(old).alias(new) for new, old in columns.items()])


def _costs_after(chunks: DataFrame, fixups: int) -> DataFrame:
    """_conv, _chunk, _after: the costs after each chunk, up to a constant."""
    guess = F.array(*[F.lit(int(c)) for c in _END])
    costs = stored(chunks.select(*_WHERE, guess.alias("_after"), _costs_before("_codes", guess).alias("_costs")), "costs")
    for _ in range(fixups):
        real = _shifted(costs, 1, _real="_costs")
        wrong = stored(costs.join(real, _WHERE).where("_after <> _real").select(*_WHERE, "_real"), "wrong")
        if wrong.isEmpty():
            return costs
        again = chunks.join(wrong, _WHERE).select(*_WHERE, F.col("_real").alias("_after"), _costs_before("_codes", "_real").alias("_costs"))
        costs = stored(costs.join(wrong.select(*_WHERE), _WHERE, "left_anti").unionByName(again), "costs")
    real = _shifted(costs, 1, _real="_costs")
    unsettled = stored(costs.join(real, _WHERE).where("_after <> _real").select("_conv").distinct(), "unsettled")
    if unsettled.isEmpty():
        return costs
    exact = _exact(chunks.join(unsettled, "_conv", "left_semi"))
    return stored(costs.join(unsettled, "_conv", "left_anti").select(*_WHERE, "_after").unionByName(exact), "costs")


def _exact(chunks: DataFrame) -> DataFrame:
    """Costs after each chunk from products of all later matrices."""
    products = stored(chunks.select(*_WHERE, _cost_matrix("_codes").alias("_m")), "products")
    longest, step = products.agg(F.max("_chunk")).first()[0] + 1, 1
    while step < longest:
        joined = products.join(_shifted(products, step, _next="_m"), _WHERE, "left")
        product = F.when(F.col("_next").isNotNull(), _product(F.col("_m"), F.coalesce("_next", "_m"))).otherwise(F.col("_m"))
        products, step = stored(joined.select(*_WHERE, product.alias("_m")), "products"), 2 * step
    later = _shifted(products.select(*_WHERE, _applied("_m").alias("_v")), 1, _after="_v")
    end = F.array(*[F.lit(int(c)) for c in _END])
    return chunks.select(*_WHERE).join(later, _WHERE, "left").withColumn("_after", F.coalesce("_after", end))


def _entered(chunks: DataFrame) -> DataFrame:
    """_conv, _chunk, _state: the state in which each chunk is entered, from the chunks before it."""
    start = F.lit(_START)
    longest, step = (chunks.agg(F.max("_chunk")).first()[0] or 0) + 1, 1
    if longest == 1:
        return chunks.select(*_WHERE, start.alias("_state"))
    paths = stored(chunks.select(*_WHERE, _exits("_codes", "_after").alias("_to")), "paths")
    while step < longest:
        joined = paths.join(_shifted(paths, -step, _earlier="_to"), _WHERE, "left")
        both = F.transform("_earlier", lambda q: F.get(F.col("_to"), q))
        paths, step = stored(joined.select(*_WHERE, F.coalesce(both, F.col("_to")).alias("_to")), "paths"), 2 * step
    before = _shifted(paths.select(*_WHERE, F.get("_to", start).alias("_q")), -1, _state="_q")
    return paths.select(*_WHERE).join(before, _WHERE, "left").withColumn("_state", F.coalesce("_state", start))


def _solved(turns: DataFrame, span: int, fixups: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their faults, and the chunks with their edits."""
    rows = _faults(turns, span)
    chunks = _chunks(rows)
    known = stored(chunks.join(_costs_after(chunks, fixups).select(*_WHERE, "_after"), _WHERE), "known")
    edits = known.join(_entered(known), _WHERE).select(
        *_WHERE, "_is_last", _edits("_codes", "_after", "_state", "_is_last").alias("_e")
    )
    return rows, stored(edits.select(*_WHERE, "_is_last", "_e.*"), "edits")


def _repaired(rows: DataFrame, edits: DataFrame, span: int) -> DataFrame:
    """_conv, place, step, edit, turn, role, text of the turns that a repaired conversation has."""
    place = (F.col("_chunk") * span + F.col("_at")).cast("long")
    size = F.size("letters")
    listed = edits.select("_conv", "_chunk", "letters", "roles", F.posexplode("put").alias("_at", "_put"), size.alias("_size"))
    each = listed.select(
        "_conv", place.alias("_rank"), "_put", F.get("letters", F.col("_at")).alias("_letter"), F.get("roles", F.col("_at")).alias("_role"),
    )
    put = each.select("_conv", F.col("_rank").alias("place"), F.posexplode("_put").alias("step", "role")).select(
        "_conv", "place", "step", F.lit("I").alias("edit"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), "role", F.lit("").alias("text"),
    )
    # A row comes after what is put in before it: never more than two turns.
    kept = each.where("_letter in ('K', 'R')").join(rows.select("_conv", "_rank", "turn", "role", "text"), ["_conv", "_rank"]).select(
        "_conv", F.col("_rank").alias("place"), F.lit(9).alias("step"), F.col("_letter").alias("edit"), "turn",
        F.coalesce("_role", "role").alias("role"), "text",
    )
    return put.unionByName(kept)


def _ids(turns: DataFrame) -> DataFrame:
    return turns.select(_key(F.col("conv_id")).alias("_conv"), "conv_id").distinct()


def _named(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    columns = ((conv_id, "conv_id"), (turn, "turn"), (role, "role"), (text, "text"))
    return conversations.select(*[F.col(f"`{old}`").alias(new) for old, new in columns])


def repaired(conversations: DataFrame, span: int = SPAN, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """conv_id, place, step, edit, turn, role, text: the repaired conversations, in order of place and step.

    Rows are taken by turn, nulls first; within a turn by role and text, equal
    rows together. A null role or text is one space. ``edit`` is K, R or I;
    turns put in have no turn number and an empty text. A row is blank without
    a character other than ASCII white space. Roles count by their first
    letter, an empty one by none. Conversations with nothing left give no rows,
    a null id is one conversation, extra columns are not read.
    """
    turns = _named(conversations, conv_id, turn, role, text)
    rows, edits = _solved(turns, span, FIXUPS)
    return _repaired(rows, edits, span).join(_ids(turns), "_conv").select("conv_id", "place", "step", "edit", "turn", "role", "text")


def _digests(lines: DataFrame) -> DataFrame:
    """_conv, repaired_sha256 from the repaired lines, read in order; a worker holds one batch of lines."""
    line = F.struct("place", "step", F.concat_ws(":", "role", "text").alias("line"))
    blocks = lines.groupBy("_conv", F.floor(F.col("place") / LINES).alias("_block")).agg(F.sort_array(F.collect_list(line)).alias("_l"))
    blocks = blocks.select("_conv", "_block", F.array_join(F.col("_l")["line"], "\n").alias("_lines"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, names, values = None, None, [], []
        for batch in batches:
            for conv, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if conv != now:
                    if held is not None:
                        names.append(now)
                        values.append(held.hexdigest())
                    now, held = conv, hashlib.sha256(some.encode())
                else:
                    held.update(b"\n" + some.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], names=["_conv", "repaired_sha256"])
            names, values = [], []
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([held.hexdigest()])], names=["_conv", "repaired_sha256"])

    in_order = blocks.repartition("_conv").sortWithinPartitions("_conv", "_block").select("_conv", "_lines")
    return in_order.mapInArrow(digest, "_conv string, repaired_sha256 string")


def _legal(a: str, b: str) -> Column:
    """Whether these initials may follow each other: su, ua, au."""
    pair = F.col(a) * 4 + F.col(b)
    return pair.isin(0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1)


def audit(conversations: DataFrame, among: DataFrame | None = None, span: int = SPAN, fixups: int = FIXUPS, conv_id: str = "conv_id",
          turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    See ``repaired`` for the order of rows and for nulls. ``among`` may name
    conversations (conv_id) that have to be there even without rows: they get
    zeros, an empty audit and the digest of nothing. A digest reads its
    conversation from start to end, one block of lines after another, in one
    task; everything else is spread by chunks of ``span`` rows.
    """
    turns = _named(conversations, conv_id, turn, role, text)
    rows, edits = _solved(turns, span, fixups)
    distinct = rows.where("turn is not null").select("_conv", "turn").distinct().groupBy("_conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps")
    )
    n = F.col("n")
    counts = rows.groupBy("_conv").agg(
        F.sum(F.when(F.col("_blank"), n).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("_again"), n).when(~F.col("_blank"), n - 1).otherwise(0)).alias("duplicate"),
        F.sum(F.col("_open").cast("long")).alias("truncated"),
        # Equal rows beside each other are never legal.
        F.sum(n - 1).alias("_equal"),
    )
    after = rows.select("_conv", (F.col("_rank") - 1).alias("_rank"), F.col("_initial").alias("_next"))
    pairs = rows.select("_conv", "_rank", "_initial").join(after, ["_conv", "_rank"])
    illegal = pairs.where(~_legal("_initial", "_next")).groupBy("_conv").agg(F.count(F.lit(1)).alias("_unequal"))
    # Further copies of a row follow its letter as deletions.
    copies = rows.where("n > 1").groupBy("_conv", "_chunk").agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("_rank") % span).cast("int"), (n - 1).cast("int")))).alias("_more")
    )

    def letters(more: Column) -> Column:
        def one(letter: Column, at: Column) -> Column:
            put = F.repeat(F.lit("I"), F.size(F.get("put", at)))
            further = F.coalesce(F.element_at(more, at), F.lit(0))
            # Deletions first: a turn is put in before a row only where the row cannot be deleted first.
            return F.concat(put, letter, F.repeat(F.lit("D"), further))
        tail = F.repeat(F.lit("I"), F.size(F.element_at("put", -1)))
        return F.concat(F.array_join(F.transform("letters", one), ""), tail)

    pieces = edits.join(copies, _WHERE, "left").select(
        "_conv", "cost", F.struct("_chunk", letters(F.coalesce("_more", F.create_map().cast("map<int,int>"))).alias("_text")).alias("_piece"),
        F.coalesce(F.aggregate(F.map_values("_more"), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).alias("_copies"),
    )
    audits = pieces.groupBy("_conv").agg(
        (F.sum("cost") + DELETE * F.sum("_copies")).alias("cost"),
        F.array_join(F.sort_array(F.collect_list("_piece"))["_text"], "").alias("audit"),
    )
    out = _ids(turns if among is None else turns.select("conv_id").unionByName(among.select("conv_id")))
    for part in (distinct, counts, illegal, audits, _digests(_repaired(rows, edits, span))):
        out = out.join(part, "_conv", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "conv_id", *[F.coalesce(F.col(c), zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated")],
        (F.coalesce("_equal", zero) + F.coalesce("_unequal", zero)).alias("illegal"), F.coalesce("cost", zero).alias("cost"),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The fixture: conv_id, turn, role, text with some rows dropped, emptied, cut, repeated or under another role.

    The checksum of ``conv_id:turn`` decides, a null counting as one space.
    """
    rows = _named(conversations, conv_id, turn, role, text)
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    fate = F.crc32(name.cast("binary")) % 20
    body = F.coalesce("text", space)
    changed = rows.withColumn("_fate", fate).where("_fate <> 0").withColumns({
        "text": F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body),
        "role": F.when(F.col("_fate") == 4, "user").otherwise(F.coalesce("role", space)),
    })
    times = F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changed.withColumn("_time", F.explode(times)).select("conv_id", "turn", "role", "text")
