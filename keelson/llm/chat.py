"""Chat formatting with minimum-cost role repair.

A legal conversation has at most one system turn, at its start, and then user and assistant turns in turn, the user
first.  Each turn read may begin a new turn under its role or, at a cost, under another (relabel), be joined to the
turn before it (merge), or be led by an empty turn of the role that is missing (insert).  Dynamic programming over
the automaton of legal turns finds the cheapest repair; of equally cheap ones the first in the order of ``_MOVES``.

The best cost between two states over a stretch of turns composes with that of the next stretch, so a conversation is
handled in stretches of about ``STRETCH`` rows, a row with its turns in order each.  Of conversations with more than one,
first the cost tables of stretches, then those of ``FAN`` stretches in a row, of ``FAN`` such tables and so on, then the
cheapest way down again; at last the repair inside each stretch.  Python reads roles alone and returns moves, texts stay
in Spark.  No task holds more of a conversation than a stretch with its texts, or ``FAN`` tables.

Null and unknown roles can be any role at the cost of a relabel; null texts are empty; null turn numbers come last,
equal ones are ordered by role and digest of the text (where a number and role have very many rows, texts with very
many equal rows come after the others with the same beginning of the digest), so repeated rows are merged like any
turns of one role; rows without a conversation id are conversations of one turn (repeated rows of one); an empty table
gives an empty result.  Other columns are not carried along.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.storage import cut

STRETCH = 256
#: Tables of so many stretches in a row are composed in one task.
FAN = 256
#: A chunk of turn numbers, and a number and role, are divided from so many times ``STRETCH`` rows up.
_ROOM = 4
RELABEL, MERGE, INSERT = 4, 2, 3
ROLES = ("system", "user", "assistant")
#: Other names that roles go by (fixed values).
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "developer": "system"}
#: States of the automaton: nothing yet, or the role of the last turn.
STATES = ("start", *ROLES)
#: (state, role, next state, action): what a turn may do that is read as ``role``.
_MOVES = (
    [("start", "system", "system", "keep"), ("start", "user", "user", "keep"), ("system", "user", "user", "keep"), ("user", "assistant", "assistant", "keep"), ("assistant", "user", "user", "keep")]
    + [(r, r, r, "merge") for r in ROLES]
    + [("start", "assistant", "assistant", "insert"), ("system", "assistant", "assistant", "insert"), ("user", "user", "user", "insert"), ("assistant", "assistant", "assistant", "insert")]
)
_ACTION_COST = {"keep": 0, "merge": MERGE, "insert": INSERT}
_FAR = 1 << 60
_END = "<|im_end|>\n"


def known_role(role: str | None) -> str | None:
    name = (role or "").strip().lower()
    return name if name in ROLES else ALIASES.get(name)


def best_ways(roles: list[str | None], start: str) -> list[dict[str, tuple[int, int]]]:
    """After each turn: for each state that can be reached from ``start``, the least cost and the last move."""
    ways: list[dict[str, tuple[int, int]]] = [{start: (0, -1)}]
    for role in roles:
        known, after = known_role(role), {}
        for number, (state, read, to, action) in enumerate(_MOVES):
            if state in ways[-1]:
                cost = ways[-1][state][0] + _ACTION_COST[action] + (RELABEL if read != known else 0)
                if cost < after.get(to, (_FAR,))[0]:
                    after[to] = (cost, number)
        ways.append(after)
    return ways


def moves_between(roles: list[str | None], start: str, end: str) -> list[int]:
    """The cheapest moves that lead from ``start`` to ``end``."""
    ways, state, moves = best_ways(roles, start), end, []
    for i in range(len(roles), 0, -1):
        number = ways[i][state][1]
        moves.append(number)
        state = _MOVES[number][0]
    return moves[::-1]


@functools.lru_cache(maxsize=1024)
def _codes(known: tuple[str | None, ...], start: str, end: str | None) -> list[int]:
    """For each turn twice the number of its move, and one more if it is relabelled; without ``end`` to the cheapest one."""
    if end is None:
        reached = best_ways(list(known), start)[-1]
        end = min(reached, key=lambda state: (reached[state][0], STATES.index(state)))
    return [2 * move + (_MOVES[move][1] != role) for move, role in zip(moves_between(list(known), start, end), known)]


def codes_of(roles: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    """The codes of each row's roles; conversations with the same roles in a row are repaired once."""
    return pd.Series([_codes(tuple(map(known_role, r)), s, e) for r, s, e in zip(roles, start, end)], dtype=object)


def _key() -> list[Column]:
    """Where a row lies, never null and in order: chunk, number and role in a busy chunk, digest in a crowded role, piece."""
    return [F.col(c) for c in ("conv", "chunk", "at_turn", "at_role", "at_digest", "piece")]


def _stretches(turns: DataFrame) -> DataFrame:
    """The turns with ``conv`` (never null), ``digest`` of the text, ``stretch`` (from 0, in order) and ``last``.

    A stretch is a chunk of turn numbers; a busy chunk has a stretch for each number and role; a crowded number and
    role one for each beginning of the digest, long enough to leave about ``STRETCH`` rows.  There, rows alike in
    everything are counted and dealt over pieces, so any number of them never meets in one place.
    """
    number = F.col("turn").cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), number.alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    own = F.md5(F.to_json(F.struct("turn", "role", "text")))  # rows without conversation id are told apart by this
    rows = rows.withColumn("lone", F.when(F.col("conv_id").isNull(), own).otherwise(""))
    rows = rows.withColumns({
        "conv": F.coalesce(F.col("conv_id").cast("string"), "lone"),
        "digest": F.coalesce(F.md5("text"), F.lit("g" * 32)),  # null texts come last
        "chunk": F.floor(F.coalesce("turn", F.lit(2**62)) / STRETCH).cast("long"),
        "_turn": F.coalesce("turn", F.lit(0)), "_role": F.coalesce("role", F.lit("\uffff")),
    })
    sizes = cut(rows.groupBy("conv", "chunk", "_turn", "_role").agg(F.count(F.lit(1)).alias("n")).where(F.col("conv").isNotNull()))
    busy = sizes.groupBy("conv", "chunk").agg(F.sum("n").alias("n")).where(F.col("n") > _ROOM * STRETCH).select("conv", "chunk", F.lit(True).alias("busy"))
    digits = F.least(F.ceil(F.log(16.0, F.col("n") / STRETCH)).cast("int"), F.lit(32)).alias("digits")
    crowded = sizes.where(F.col("n") > _ROOM * STRETCH).select("conv", "chunk", "_turn", "_role", digits)
    marked = rows.join(cut(busy), ["conv", "chunk"], "left").join(cut(crowded), ["conv", "chunk", "_turn", "_role"], "left")
    marked = marked.withColumns({"at_turn": F.when(F.col("busy"), F.col("_turn")).otherwise(0), "at_role": F.when(F.col("busy"), F.col("_role")).otherwise("")})
    shared = ["conv", "conv_id", "lone", "chunk", "at_turn", "at_role", "turn", "role", "text", "digest"]
    plain = marked.where("digits is null").select(*shared, F.lit("").alias("at_digest"), F.lit(0).alias("piece"), F.lit(1).alias("alike"))

    counted = marked.where("digits is not null").groupBy(*shared, "digits").agg(F.count(F.lit(1)).alias("all_alike"))
    begin = F.when(F.col("all_alike") > STRETCH, F.col("digest")).otherwise(F.substring(F.col("digest"), F.lit(1), F.col("digits")))
    pieces = counted.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("all_alike") - 1) / STRETCH).cast("int"))))
    alike = F.least(F.lit(STRETCH), F.col("all_alike") - F.col("piece") * STRETCH).cast("int")
    dealt = cut(plain.unionByName(pieces.select(*shared, begin.alias("at_digest"), "piece", alike.alias("alike"))))

    order = Window.partitionBy("conv").orderBy(*_key()[1:])
    spots = dealt.select(*_key()).distinct()
    numbered = cut(spots.withColumns({"stretch": F.row_number().over(order).cast("long") - 1, "last": F.lead("conv").over(order).isNull()}))
    placed = dealt.join(numbered, ["conv", "chunk", "at_turn", "at_role", "at_digest", "piece"])
    copies = F.explode(F.sequence(F.lit(1), F.col("alike"))).alias("_copy")
    return placed.select("conv", "conv_id", "lone", "stretch", "last", "turn", "role", "text", "digest", copies).drop("_copy")


_TABLE = "conv string, stretch long, start_state string, end_state string, cost long"
_TABLE_ARROW = pa.schema([("conv", pa.string()), ("stretch", pa.int64()), ("start_state", pa.string()), ("end_state", pa.string()), ("cost", pa.int64())])
Costs = dict[tuple[str, str], int]


def _steps(group: pa.Table) -> list[tuple[int, Costs]]:
    """The cost tables of a group of stretches, in order."""
    steps: dict[int, Costs] = {}
    for row in group.select(["stretch", "start_state", "end_state", "cost"]).to_pylist():
        steps.setdefault(row["stretch"], {})[row["start_state"], row["end_state"]] = row["cost"]
    return sorted(steps.items())


def ways_through(tables: list[Costs], start: str) -> list[dict[str, tuple[int, str]]]:
    """After each table: for each state that can be reached from ``start``, the least cost and the state before the table."""
    ways: list[dict[str, tuple[int, str]]] = [{start: (0, "")}]
    for table in tables:
        after: dict[str, tuple[int, str]] = {}
        for end in STATES:
            for before in STATES:
                if before in ways[-1] and (before, end) in table and ways[-1][before][0] + table[before, end] < after.get(end, (_FAR,))[0]:
                    after[end] = (ways[-1][before][0] + table[before, end], before)
        ways.append(after)
    return ways


def _composed(tables: DataFrame) -> DataFrame:
    """The tables of ``FAN`` stretches in a row as one each."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        steps = [table for _, table in _steps(group)]
        found = [(s, e, cost) for s in STATES for e, (cost, _) in ways_through(steps, s)[-1].items()]
        return pa.Table.from_pylist([dict(zip(_TABLE_ARROW.names, [key[0].as_py(), key[1].as_py(), *f])) for f in found], _TABLE_ARROW)

    return tables.withColumn("above", F.floor(F.col("stretch") / FAN)).groupBy("conv", "above").applyInArrow(run, _TABLE)


def _ways_down(tables: DataFrame, chosen: DataFrame) -> DataFrame:
    """The states between which the cheapest way passes each stretch, given those of the stretches above."""
    schema = pa.schema([*[_TABLE_ARROW.field(i) for i in range(4)], ("total_cost", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        steps = _steps(group)
        begin, state, total = (group.column(c)[0].as_py() for c in ("from_state", "to_state", "total_cost"))
        ways, out = ways_through([table for _, table in steps], begin), []
        for i in range(len(steps), 0, -1):
            before = ways[i][state][1]
            out.append(dict(zip(schema.names, [key[0].as_py(), steps[i - 1][0], before, state, total])))
            state = before
        return pa.Table.from_pylist(out, schema)

    above = chosen.select("conv", F.col("stretch").alias("above"), F.col("start_state").alias("from_state"), F.col("end_state").alias("to_state"), "total_cost")
    both = tables.withColumn("above", F.floor(F.col("stretch") / FAN).cast("long")).join(above, ["conv", "above"])
    return both.groupBy("conv", "above").applyInArrow(run, "conv string, stretch long, start_state string, end_state string, total_cost long")


def cheapest_ways(tables: DataFrame) -> DataFrame:
    """(conv, stretch, start_state, end_state, total_cost) of the cheapest way through each conversation's tables."""
    levels = [tables]
    while (levels[-1].agg(F.max("stretch")).first()[0] or 0) > 0:
        levels.append(cut(_composed(levels[-1])))
    rank = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("end_state"))
    best = F.min(F.struct(F.col("cost"), rank.alias("rank"), F.col("end_state"))).alias("best")
    chosen = levels[-1].where("start_state = 'start'").groupBy("conv").agg(best)
    chosen = chosen.select("conv", F.lit(0).cast("long").alias("stretch"), F.lit("start").alias("start_state"), F.col("best.end_state").alias("end_state"), F.col("best.cost").alias("total_cost"))
    for level in reversed(levels[:-1]):
        chosen = cut(_ways_down(level, chosen))
    return chosen


def repair(turns: DataFrame) -> DataFrame:
    """One row per turn read: conv_id, lone, stretch, place, turn, old_role, role, action, relabelled, text, piece.

    ``piece`` is what the turn adds to the rendered conversation: an empty turn before it if one was inserted, the
    opening of its own turn unless it was merged, its text, and the end of the conversation after its last turn.
    """
    in_order = F.struct(F.col("turn").isNull().alias("no_turn"), "turn", F.col("role").isNull().alias("no_role"), "role", "digest", "text")
    whole = _stretches(turns).groupBy("conv", "stretch").agg(
        F.first("conv_id").alias("conv_id"), F.first("lone").alias("lone"), F.first("last").alias("last"), F.array_sort(F.collect_list(in_order)).alias("turns")
    )
    stretches = cut(whole.withColumn("roles", F.col("turns")["role"]))
    lone_one = F.col("last") & (F.col("stretch") == 0)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                dict(zip(_TABLE_ARROW.names, [row["conv"], row["stretch"], s, e, cost]))
                for row in batch.to_pylist() for s in STATES for e, (cost, _) in best_ways(row["roles"], s)[-1].items()
            ]
            yield pa.RecordBatch.from_pylist(found, _TABLE_ARROW)

    costs = cut(stretches.where(~lone_one).select("conv", "stretch", "roles").mapInArrow(tables, _TABLE))
    ways = cheapest_ways(costs).select("conv", "stretch", "start_state", "end_state", "total_cost")
    alone = stretches.where(lone_one).select("*", F.lit("start").alias("start_state"), F.lit(None).cast("string").alias("end_state"), F.lit(None).cast("long").alias("total_cost"))
    both = alone.unionByName(stretches.where(~lone_one).join(ways, ["conv", "stretch"]))
    codes = F.pandas_udf(codes_of, "array<int>")  # type: ignore[call-overload]
    coded = both.withColumn("codes", codes("roles", "start_state", "end_state"))
    priced = F.array(*[F.lit(_ACTION_COST[action] + relabel) for *_, action in _MOVES for relabel in (0, RELABEL)])
    own_cost = F.aggregate("codes", F.lit(0).cast("long"), lambda total, code: total + F.get(priced, code))
    coded = coded.withColumn("total_cost", F.coalesce("total_cost", own_cost))
    each = coded.select("conv_id", "lone", "stretch", "last", "total_cost", F.size("codes").alias("n"), F.posexplode(F.arrays_zip("turns", "codes")).alias("at", "one"))

    def of_move(values: list[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.floor(F.col("one.codes") / 2).cast("int"))

    lead = []  # what each move puts before the text
    for state, role, _, action in _MOVES:
        empty_turn = f"<|im_start|>{'user' if role == 'assistant' else 'assistant'}\n{_END}" if action == "insert" else ""
        lead.append("\n" if action == "merge" else f"{'' if state == 'start' else _END}{empty_turn}<|im_start|>{role}\n")
    text = F.replace(F.coalesce("one.turns.text", F.lit("")), F.lit("<|"), F.lit("< |"))  # cannot be taken for a marker of turns
    closed = F.when(F.col("last") & (F.col("at") == F.col("n") - 1), _END).otherwise("")
    return each.select(
        "conv_id", "lone", "stretch", F.col("at").cast("long").alias("place"), "one.turns.turn", F.col("one.turns.role").alias("old_role"),
        of_move([role for _, role, _, _ in _MOVES]).alias("role"), of_move([action for *_, action in _MOVES]).alias("action"),
        (F.col("one.codes") % 2 == 1).alias("relabelled"), "total_cost", "one.turns.text", F.concat(of_move(lead), text, closed).alias("piece"),
    )


def _rendered(repaired: DataFrame, keys: list[str]) -> DataFrame:
    count = lambda c: F.sum(c.cast("long"))
    pieces = F.array_sort(F.collect_list(F.struct("stretch", "place", "piece")))
    merged, inserted = F.col("action") == "merge", F.col("action") == "insert"
    return repaired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_turns"),
        (count(~merged) + count(inserted)).alias("n_out"),
        count(merged).alias("n_merged"),
        count(F.col("relabelled")).alias("n_relabelled"),
        count(inserted).alias("n_inserted"),
        F.max("total_cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("rendered"),
    ).drop("lone")


def render_parts(repaired: DataFrame) -> DataFrame:
    """One row per stretch: conv_id, part (from 0), the counts of :func:`render` in it, cost of the conversation, rendered.

    The parts of a conversation, in order, are its whole text; a conversation of ordinary length has one.
    """
    return _rendered(repaired, ["conv_id", "lone", "stretch"]).withColumnRenamed("stretch", "part")


def render(repaired: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, n_turns, n_out, n_merged, n_relabelled, n_inserted, cost, rendered.

    Only for conversations that fit in a row; :func:`render_parts` is bounded.
    """
    return _rendered(repaired, ["conv_id", "lone"])
