"""Per-key ordering questions, answered without sorting a whole key in one task."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.skew import attach_groups, attach_per_key, stored_small
from eventloom.session import cut_lineage


def count_per_key(rows: DataFrame, keys: list[str], name: str = "key_count") -> DataFrame:
    """Every row with the number of rows that share its key (null is a key of its own)."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias(name))
    return attach_per_key(rows, counts, keys, name, [name])


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key. Partial aggregation keeps one row per key and task."""
    newest = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(newest).select("_row.*")


def later_copies(rows: DataFrame, keys: list[str], order: str, name: str = "is_later_copy") -> DataFrame:
    """Flag each row that is not the first of its key by ``order``."""
    first = rows.groupBy(*keys).agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
    joined = attach_per_key(rows, first, keys, "_n", ["_first"])
    return joined.withColumn(name, F.col(order) > F.col("_first")).drop("_first")


#: Pieces that one step makes of a heavy group.
_FAN = 64


def _measured(rows: DataFrame, column: str, offset: int) -> Column:
    """A value that quantiles can be taken of and that never runs against the order of the column; seven bytes of a text."""
    kind = rows.schema[column].dataType
    if isinstance(kind, T.StringType):
        part = F.substring(F.col(column).cast("binary"), offset + 1, 7)
        return F.conv(F.rpad(F.hex(part), 14, "0"), 16, 10).cast("bigint")
    return F.col(column).cast("int") if isinstance(kind, T.BooleanType) else F.col(column)


def in_pieces(rows: DataFrame, keys: list[str], order: list[str], piece_rows: int) -> DataFrame:
    """Add ``_piece``: null for ordinary keys, and for a key with more than ``piece_rows`` rows the number of the
    piece a row falls in. Pieces follow ``order`` and hold about ``piece_rows`` rows; rows equal in ``order`` share one.

    Heavy keys are cut at quantiles from mergeable sketches, one small row per key, and pieces that are still too heavy
    are cut again, by the next column where one is constant. The cuts are stored, so every later step sees the same
    pieces; three numbers a step come to the driver, whatever the number of pieces.
    """
    heavy = cut_lineage(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > piece_rows))
    if heavy.isEmpty():
        return rows.withColumn("_piece", F.lit(None).cast("bigint"))
    marked = attach_groups(rows, heavy, keys, "_n", ["_n"])
    piece = F.when(F.col("_n").isNotNull(), F.lit(0).cast("bigint")).alias("_piece")
    cut = marked.select(*rows.columns, piece)
    shares = F.array(*[F.lit(i / _FAN) for i in range(1, _FAN)])
    place, offset = 0, 0
    while place < len(order):
        column = order[place]
        long = isinstance(rows.schema[column].dataType, T.StringType)
        value = _measured(rows, column, offset)
        groups = cut.where(F.col("_piece").isNotNull()).groupBy(*keys, "_piece").agg(
            F.count("*").alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(value).alias("_known"),
            F.percentile_approx(value, shares, F.lit(10_000)).alias("_cuts"), F.max(F.octet_length(column) if long else F.lit(0)).alias("_length"),
        )
        groups = cut_lineage(groups.where(F.col("_n") > piece_rows))
        mixed = "_low < _high OR (_known > 0 AND _known < _n)"
        state = groups.agg(F.count("*").alias("groups"), F.count_if(F.expr(mixed)).alias("mixed"), F.max("_length").alias("length")).first()
        if not state.groups:
            break
        if state.mixed:
            # Nulls come first and the smallest value is a cut too, so that every step divides whatever is not constant.
            cuts = groups.where(mixed).select(*keys, "_piece", "_n", F.array_union(F.array("_low"), "_cuts").alias("_cuts"))
            joined = attach_groups(cut.where(F.col("_piece").isNotNull()), cuts, [*keys, "_piece"], "_n", ["_cuts"])
            inside = F.when(F.col("_cuts").isNull() | value.isNull(), 0).otherwise(1 + F.size(F.filter("_cuts", lambda c: c < value)))
            deeper = joined.withColumn("_piece", F.col("_piece") * (2 * _FAN) + inside).drop("_cuts")
            cut = cut.where(F.col("_piece").isNull()).unionByName(deeper.select(cut.columns))
        elif long and offset + 7 < (state.length or 0):
            offset += 7
        else:
            place, offset = place + 1, 0
    return cut


def with_neighbour(
    rows: DataFrame, keys: list[str], order: list[str], values: list[str], name: str, step: int, piece_rows: int = 1_000_000
) -> DataFrame:
    """Add struct ``name`` holding ``values`` of the previous (``step=-1``) or next (``step=1``) row of the key.

    The pieces of a heavy key are sorted apart; the row at the edge of a piece takes its neighbour from the edge
    of the adjoining piece.
    """
    own = F.struct(*values)
    parts = in_pieces(rows, keys, order, piece_rows)
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    inner = parts.withColumn("_near", F.lag(own, 1).over(inside) if step < 0 else F.lead(own, 1).over(inside))
    cut = parts.where(F.col("_piece").isNotNull())
    edge_row = F.max_by(own, F.struct(*order)) if step < 0 else F.min_by(own, F.struct(*order))
    edges = cut.groupBy(*keys, "_piece").agg(edge_row.alias("_edge"))
    along = Window.partitionBy(*keys).orderBy("_piece")
    carry = F.lag("_edge", 1).over(along) if step < 0 else F.lead("_edge", 1).over(along)
    edges = stored_small(
        edges.select(*[F.col(k).alias(f"_e_{k}") for k in keys], F.col("_piece").alias("_e_piece"), carry.alias("_carry"))
    )
    match = inner["_piece"] == edges["_e_piece"]
    for key in keys:
        match = match & inner[key].eqNullSafe(edges[f"_e_{key}"])
    return inner.join(edges, match, "left").select(
        *[inner[c] for c in rows.columns], F.coalesce("_near", "_carry").alias(name)
    )


def top_per_group(counts: DataFrame, group: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group of an already aggregated frame."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return counts.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


# Balance after one movement ``m`` on balance ``b``; a withdrawal above the balance is declined.
_STEP = "CASE WHEN b + m.{amount} < 0 THEN b ELSE CAST(b + m.{amount} AS DECIMAL(38,2)) END"


_OUTCOME = T.StructType([T.StructField("accepted", T.BooleanType()), T.StructField("balance", T.DecimalType(38, 2))])


@F.pandas_udf(_OUTCOME)
def _replay(moves: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """Outcome of each movement. The movements of a piece follow each other from place 0 on, in one batch or several."""
    balance = None
    for places, starts, amounts in moves:
        accepted, balances = [], []
        for place, start, move in zip(places.tolist(), starts.tolist(), amounts.tolist()):
            if place == 0:
                balance = start
            accepted.append(balance + move >= 0)
            balance = balance + move if accepted[-1] else balance
            balances.append(balance)
        yield pd.DataFrame({"accepted": accepted, "balance": balances})


# A later filter must not take movements away before the replay has seen them.
_replay = _replay.asNondeterministic()


def running_balance(
    rows: DataFrame, account: str, order: list[str], amount: str, opening: str = "0", piece_rows: int = 100_000
) -> DataFrame:
    """Every movement with ``accepted`` and ``balance``; a declined withdrawal changes nothing.

    An account of at most ``piece_rows`` movements is replayed as one piece. The pieces of a longer history are
    replayed in parallel: a piece starts from the opening balance plus the net change of all earlier pieces. A
    wrong start can change which withdrawals are declined, so these accounts are replayed until no net change
    moves; the n-th piece is final after at most n rounds, and an account leaves the rounds when all its pieces
    are final.
    """
    exact = "decimal(38,2)"  # as wide as ``money``
    others = [c for c in rows.columns if c not in (account, amount, *order)]
    cut = in_pieces(rows, [account], order, piece_rows)
    moves = F.sort_array(F.collect_list(F.struct(*order, F.col(amount).cast(exact).alias(amount), *others)))
    pieces = cut_lineage(cut.groupBy(account, "_piece").agg(moves.alias("_moves")))

    whole = pieces.where(F.col("_piece").isNull()).select(account, F.lit(opening).cast(exact).alias("_start"), "_moves")
    parts = pieces.where(F.col("_piece").isNotNull())
    plain_sum = F.expr(f"aggregate(_moves, CAST(0 AS {exact}), (b, m) -> CAST(b + m.{amount} AS {exact}))")
    replayed_net = F.expr(f"aggregate(_moves, _start, (b, m) -> {_STEP.format(amount=amount)})") - F.col("_start")
    per_account = Window.partitionBy(account)
    earlier = per_account.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    start = (F.lit(opening).cast(exact) + F.coalesce(F.sum("_net").over(earlier), F.lit(0))).cast(exact)
    nets = parts.select(account, "_piece", plain_sum.alias("_net"))

    def beside(other: DataFrame) -> DataFrame:
        """The pieces with the columns of ``other``; a null account is an account of its own."""
        side = other.withColumnsRenamed({account: "_a", "_piece": "_p"})
        return parts.join(side, parts[account].eqNullSafe(F.col("_a")) & (parts["_piece"] == F.col("_p"))).drop("_a", "_p")

    ready = [whole]
    while not nets.isEmpty():
        starts = nets.select(account, "_piece", start.alias("_start"), F.col("_net").alias("_was"))
        replayed = beside(starts).withColumn("_net", replayed_net.cast(exact))
        moved = F.max(F.col("_net") != F.col("_was")).over(per_account)
        judged = cut_lineage(replayed.select(account, "_piece", "_start", "_net", moved.alias("_moved")))
        final = judged.where(~F.col("_moved")).select(account, "_piece", "_start")
        ready.append(beside(final).select(account, "_start", "_moves"))
        nets = judged.where("_moved").select(account, "_piece", "_net")

    # Python sees single movements, so its batches have one size however long the pieces are.
    lines = reduce(DataFrame.unionByName, ready).select(account, "_start", F.posexplode("_moves").alias("_place", "_move"))
    judged = lines.withColumn("_outcome", _replay("_place", "_start", F.col(f"_move.{amount}")))
    return judged.select(
        *[F.col(c) if c == account else F.col(f"_move.{c}").alias(c) for c in rows.columns], "_outcome.*"
    )


def exact_median(rows: DataFrame, value: str, by: list[str], pieces: int = 256, name: str = "median") -> DataFrame:
    """Exact median per group without gathering a group's values in one task; equal values are counted first."""
    return median_of_counts(rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n")), value, by, "_n", pieces, name)


def median_of_counts(
    counts: DataFrame, value: str, by: list[str], weight: str, pieces: int = 256, name: str = "median"
) -> DataFrame:
    """Exact median per group of counted values.

    Approximate quantiles of the different values only choose where to cut the value range; the exact counts per piece
    then tell which piece holds the middle, and only that piece is ordered.
    """
    freq = counts.select(*by, value, F.col(weight).alias("_n"))
    shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    cuts = freq.groupBy(*by).agg(
        F.percentile_approx(value, shares, F.lit(10_000)).alias("_cuts"), F.count("*").alias("_weight")
    )
    placed = cut_lineage(
        attach_groups(freq, cuts, by, "_weight", ["_cuts"])
        .withColumn("_piece", F.size(F.filter("_cuts", lambda c: c < F.col(value))))
        .drop("_cuts")
    )
    groups = Window.partitionBy(*by)
    along = groups.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "_piece").agg(F.sum("_n").alias("_rows"))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_rows").over(along), F.lit(0))).withColumn(
        "_total", F.sum("_rows").over(groups)
    )
    low, high = F.expr("(_total + 1) div 2"), F.expr("(_total + 2) div 2")
    middle = totals.where((F.col("_before") < high) & (F.col("_before") + F.col("_rows") >= low)).select(
        *[F.col(k).alias(f"_m_{k}") for k in by], F.col("_piece").alias("_m_piece"), "_before", "_total"
    )
    middle = stored_small(middle)
    on = placed["_piece"] == middle["_m_piece"]
    for key in by:
        on = on & placed[key].eqNullSafe(middle[f"_m_{key}"])
    inside = Window.partitionBy(*by, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(middle, on).withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
    first = F.col("_upto") - F.col("_n")
    hits = ranked.where((first < high) & (F.col("_upto") >= low))
    return hits.groupBy(*by).agg(((F.min(value) + F.max(value)) / 2).alias(name))
