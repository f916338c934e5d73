"""Linking names by similarity inside a block (suburb and postcode).

Similarity is ``1 - levenshtein / longer length``; as a percentage it is
rounded to an integer and the cost of a pair is 100 minus it.

A block may hold a third of all names, so the pairs of a block are never formed.
Texts few edits apart share an unchanged piece at nearly the same place: choices
are indexed by their pieces, and an equality join on block, lengths, place and
piece finds the pairs worth comparing.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, cut_lineage
from .components import components
from .keys import small_id
from .quality import repeated_keys

# Cost of leaving a name without partner, and the highest cost of a pair.
UNMATCHED_COST = 100
MAX_COST = 20


def similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def pair_cost(a: Column, b: Column) -> Column:
    return (F.lit(100) - F.round(similarity(a, b) * 100).cast("int")).cast("int")


# ------------------------------------------------------------ pieces

Bound = tuple[int, int]
"""Edits allowed, as a share of the longer length: numerator and denominator."""


def _edits(length: Column, bound: Bound) -> Column:
    return F.floor(length * bound[0] / bound[1]).cast("int")


def _longest_partner(length: Column, bound: Bound) -> Column:
    """No text longer than this is within the bound of one of this length."""
    return F.floor((length + 1) * bound[1] / (bound[1] - bound[0])).cast("int")


def _cut(length: Column, pieces: Column, k: Column) -> Column:
    """Where the k-th of so many even pieces begins."""
    return F.floor(k * length / pieces).cast("int")


def _indexed(choices: DataFrame, block: list[str], bound: Bound) -> DataFrame:
    """Each choice cut into one piece more than edits are allowed, for every number of edits a partner may bring."""
    length = F.length("_choice")
    sized = choices.select(
        *block, "_choice", length.alias("_len"),
        F.explode(F.sequence(_edits(length, bound), _edits(_longest_partner(length, bound), bound))).alias("_d"),
    )
    numbered = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("_d"))).alias("_k"))
    start, end = (_cut(F.col("_len"), F.col("_d") + 1, F.col("_k") + i) for i in (0, 1))
    return numbered.select(*block, "_len", "_d", "_k", F.substring("_choice", start + 1, end - start).alias("_piece"), "_choice")


def _probes(names: DataFrame, block: list[str], bound: Bound) -> DataFrame:
    """The parts of each name that a piece of a near choice can be equal to.

    If two texts are ``d`` edits apart and one is cut into ``d + 1`` pieces,
    some piece ``k`` is unchanged, with at most ``k`` edits before and
    ``d - k`` after it; that bounds where it can stand in the other text.
    """
    length = F.length("_name")
    least = F.greatest(length - _edits(length, bound), F.lit(0))
    sized = names.select(
        *block, "_name", length.alias("_own"), F.explode(F.sequence(least, _longest_partner(length, bound))).alias("_len")
    ).withColumn("_d", _edits(F.greatest("_own", "_len"), bound))
    fitting = sized.filter(F.abs(F.col("_own") - F.col("_len")) <= F.col("_d"))
    numbered = fitting.select("*", F.explode(F.sequence(F.lit(0), F.col("_d"))).alias("_k"))
    start, end = (_cut(F.col("_len"), F.col("_d") + 1, F.col("_k") + i) for i in (0, 1))
    shift, after = F.col("_own") - F.col("_len"), F.col("_d") - F.col("_k")
    placed = numbered.select(
        "*", (end - start).alias("_size"),
        F.greatest(start - F.col("_k"), start + shift - after, F.lit(0)).alias("_from"),
        F.least(start + F.col("_k"), start + shift + after, F.col("_own") - (end - start)).alias("_to"),
    ).filter("_from <= _to")
    return placed.select(
        *block, "_len", "_d", "_k", F.explode(F.sequence("_from", "_to")).alias("_at"), "_size", "_name"
    ).select(*block, "_len", "_d", "_k", F.expr("substring(_name, _at + 1, _size)").alias("_piece"), "_name")


def _pairs_within(names: DataFrame, choices: DataFrame, block: list[str], bound: Bound) -> DataFrame:
    """Pairs of a block among which are all within the bound; a pair may come once a common piece.

    The share of edits must not pass two fifths, so that every piece of a
    near choice holds a letter.
    """
    keys = [*block, "_len", "_d", "_k", "_piece"]
    return _probes(names, block, bound).join(_indexed(choices, block, bound), keys).select(*block, "_name", "_choice")


def _distinct_sides(
    names: DataFrame, choices: DataFrame, block: list[str], name: str, choice: str
) -> tuple[DataFrame, DataFrame]:
    left = names.select(*block, F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct()
    right = choices.select(*block, F.col(choice).alias("_choice")).filter(F.col("_choice").isNotNull()).distinct()
    return left, right


def _letters(df: DataFrame, value: str) -> DataFrame:
    return df.withColumn("_letter", F.explode(F.array_distinct(F.split(value, ""))))


def best_match(
    names: DataFrame,
    choices: DataFrame,
    block: Sequence[str],
    name: str,
    choice: str,
    min_score: float = 0.0,
    bounds: Sequence[Bound] = ((1, 5), (2, 5)),
) -> DataFrame:
    """The most similar choice of its block for every distinct name.

    Of equally similar choices the first in text order wins.  Names whose
    block has no choice (or none reaching ``min_score``) get no row.

    The bound is raised step by step: an equal choice needs no comparison;
    then a name is compared with the choices that share a piece within the
    bound, and is settled if the best one lies within it.  What is still open
    meets the choices it shares a letter with; all others have similarity
    zero, of which the first in text order will do.
    """
    block = list(block)
    left, right = _distinct_sides(names, choices, block, name, choice)
    same = right.withColumnRenamed("_choice", "_name")
    equal = left.join(same, [*block, "_name"], "left_semi").select(
        *block, F.col("_name").alias(name), F.col("_name").alias(choice), F.lit(1.0).alias("score")
    )
    open_names = left.join(same, [*block, "_name"], "left_anti")
    found = []

    def best_of(pairs: DataFrame) -> DataFrame:
        scored = F.struct((-similarity(F.col("_name"), F.col("_choice"))).alias("s"), F.col("_choice").alias("c"))
        return pairs.groupBy(*block, "_name").agg(F.min(scored).alias("_best"))

    for bound in bounds:
        best = cut_lineage(best_of(_pairs_within(open_names, right, block, bound)), "best-within")
        edits = F.levenshtein("_name", F.col("_best.c")) * bound[1]
        settled = best.filter(edits <= F.greatest(F.length("_name"), F.length("_best.c")) * bound[0])
        found.append(settled)
        open_names = cut_lineage(open_names.join(settled, [*block, "_name"], "left_anti"), "open-names")
    shared = _letters(open_names, "_name").join(_letters(right, "_choice"), [*block, "_letter"])
    nothing = F.struct((-F.lit(0.0)).alias("s"), F.col("_choice").alias("c"))
    first = open_names.join(right.groupBy(*block).agg(F.min("_choice").alias("_choice")), block)
    last = best_of(shared.select(*block, "_name", "_choice")).unionByName(first.select(*block, "_name", nothing.alias("_best")))
    found.append(last.groupBy(*block, "_name").agg(F.min("_best").alias("_best")))
    out = equal
    for part in found:
        out = out.unionByName(
            part.select(*block, F.col("_name").alias(name), F.col("_best.c").alias(choice), (-F.col("_best.s")).alias("score"))
        )
    return out.filter(F.col("score") >= min_score)


def near_pairs(
    names: DataFrame,
    choices: DataFrame,
    block: Sequence[str],
    name: str,
    choice: str,
    max_cost: int = MAX_COST,
) -> DataFrame:
    """Every pair of a block whose cost is at most ``max_cost`` (40 at most), found through common pieces."""
    if not 0 <= max_cost < 40:
        raise ValueError("a cost below 40")
    block = list(block)
    left, right = _distinct_sides(names, choices, block, name, choice)
    # A rounded cost of c stands for up to c + 1/2 percent of edits.
    pairs = _pairs_within(left, right, block, (2 * max_cost + 1, 200))
    priced = pairs.withColumn("cost", pair_cost(F.col("_name"), F.col("_choice"))).filter(F.col("cost") <= max_cost)
    return priced.distinct().select(*block, F.col("_name").alias(name), F.col("_choice").alias(choice), "cost")


def repeated_names(df: DataFrame, block: Sequence[str], name: str) -> DataFrame:
    """Names occurring more than once in a block."""
    return repeated_keys(df, [*block, name])


# ------------------------------------------------------------ one-to-one

def assign_one_to_one(
    names: DataFrame,
    choices: DataFrame,
    block: Sequence[str],
    name: str,
    choice: str,
    max_cost: int = MAX_COST,
    piece_edges: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """Pairs of minimum total cost, each name and choice used at most once, and the names left over.

    Pairs dearer than ``max_cost`` are never formed and a name without partner
    costs ``UNMATCHED_COST``.  Of several equally cheap assignments the one
    whose pairs have the least sum of ``tie_order`` is taken, so the result does
    not depend on how the work is cut.  Null names and choices take no part,
    repeated ones count once, empty tables give no pairs.

    A name and a choice near to nothing else are a pair.  All other near pairs
    fall into connected groups, settled by one auction over pieces of about
    ``piece_edges`` pairs (and at least all those of one name).
    """
    with Scratch(names.sparkSession) as scratch:
        pairs = scratch.keep(_least_cost_pairs(names, choices, list(block), name, choice, max_cost, piece_edges), "pairs")
    all_names = names.select(*block, name).filter(F.col(name).isNotNull()).distinct()
    left_over = all_names.join(pairs.select(*block, name), [*block, name], "left_anti")
    return pairs, left_over


def tie_order(*parts: Column | str) -> Column:
    """A whole number below 2**32 that settles which of equally cheap pairs are taken."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("long")


def _least_cost_pairs(
    names: DataFrame, choices: DataFrame, block: list[str], name: str, choice: str, max_cost: int, piece_edges: int
) -> DataFrame:
    edges = near_pairs(names, choices, block, name, choice, max_cost).select(
        *block,
        F.col(name).alias("_name"),
        F.col(choice).alias("_choice"),
        "cost",
        small_id(F.lit("n"), *block, name).alias("_n"),
        small_id(F.lit("c"), *block, choice).alias("_c"),
        tie_order(*block, name, choice).alias("_tie"),
    )
    edges = cut_lineage(edges, "near-pairs")
    alone = edges.groupBy("_n").agg(F.min("_c").alias("_c"), F.count(F.lit(1)).alias("_near")).filter("_near = 1")
    wanted = edges.groupBy("_c").agg(F.count(F.lit(1)).alias("_near")).filter("_near = 1")
    single = cut_lineage(alone.select("_n", "_c").join(wanted.select("_c"), "_c"), "single-pairs")
    shared = edges.select("_n", "_c", "cost", "_tie").join(single, ["_n", "_c"], "left_anti")
    chosen = single.select("_n", "_c").unionByName(auction(shared, piece_edges))
    return edges.join(chosen, ["_n", "_c"]).select(
        *block, F.col("_name").alias(name), F.col("_choice").alias(choice), "cost"
    )


_STATE = "_group long, _o long, _price decimal(38,0), _owner long, _left int"
#: Steps are powers of this; ``_left`` is the exponent, so zero is the last and finest.
FINER = 7


def auction(edges: DataFrame, piece_edges: int = 100_000) -> DataFrame:
    """``_n, _c`` of the cheapest assignment over ``_n, _c, cost, _tie``, by bidding.

    Every free bidder bids for the option worth most to it, up to the point
    where its second-best is as good, plus a step; each option goes to its
    highest bid.  To let the step start coarse and shrink (prices carry over),
    every bidder must end with an option: names and choices are therefore
    mirrored, and a name may take its own mirror image (staying alone) at worth
    zero.  Worths are whole numbers, cost before tie order, scaled by the number
    of the group's bidders plus one, so a last step of one gives the optimum.

    The bidders of a connected group are dealt to pieces.  In a round every
    piece bids on its own, knowing the prices at the round's start; options then
    take the highest price of any piece, which leaves every bid that won as good
    as it was.  A group held by one piece ends in its first round.
    """
    grouped = _with_groups(edges)
    mirror_n, mirror_c = small_id(F.lit("mirror"), "_n"), small_id(F.lit("mirror"), "_c")
    none = F.lit(None).cast("int").alias("cost"), F.lit(0).cast("long").alias("_tie")
    options = (
        grouped.select("_group", F.col("_n").alias("_p"), F.col("_c").alias("_o"), "cost", "_tie")
        .union(grouped.select("_group", mirror_c, mirror_n, "cost", "_tie"))
        .union(grouped.select("_group", "_n", mirror_n, *none).distinct())
        .union(grouped.select("_group", mirror_c, "_c", *none).distinct())
    )
    options = cut_lineage(options, "options")
    bidders = options.groupBy("_group", "_p").agg(F.count(F.lit(1)).alias("_edges"))
    sizes = bidders.groupBy("_group").agg(F.count(F.lit(1)).alias("_bidders"), F.sum("_edges").alias("_edges"))
    sizes = cut_lineage(
        sizes.select("_group", "_bidders", F.ceil(F.col("_edges") / piece_edges).alias("_pieces"), "_edges"), "group-sizes"
    )
    # Groups of one piece share tasks with others, as many as keep to the size of a piece.
    small = sizes.filter("_pieces = 1").agg(F.sum("_edges")).first()[0] or 0
    piece = F.when(F.col("_pieces") > 1, F.pmod(F.xxhash64("_p"), "_pieces"))
    shared = F.pmod(F.xxhash64("_group"), F.lit(small // piece_edges + 8))
    task = F.when(F.col("_pieces") > 1, F.xxhash64("_group", piece)).otherwise(shared)
    dealt = options.join(sizes.drop("_edges"), "_group").withColumn("_task", task)
    free, price = F.lit(None).cast("long").alias("_owner"), F.lit(0).cast("decimal(38,0)").alias("_price")
    state = options.select("_group", "_o").distinct().select("_group", "_o", price, free, F.lit(None).cast("int").alias("_left"))
    real = edges.select(F.col("_n").alias("_owner"), F.col("_c").alias("_o"))
    settled = []
    while True:
        state = _bidding_round(dealt.join(state, ["_group", "_o"]), state, sizes)
        # The mirrored half holds the same pairs again, the other way round.
        won = state.filter("_done").join(real, ["_owner", "_o"], "left_semi")
        settled.append(won.select(F.col("_owner").alias("_n"), F.col("_o").alias("_c")))
        state = state.filter("NOT _done").drop("_done")
        if state.isEmpty():
            break
        if len(settled) > 20:
            settled = [cut_lineage(_all_of(settled), "settled")]
    return _all_of(settled)


def _all_of(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _bidding_round(rows: DataFrame, state: DataFrame, sizes: DataFrame) -> DataFrame:
    """The state after all pieces have bid, with ``_done`` for groups that are settled."""
    # A column of longs with nulls would reach pandas as floats, so missing owners are marked apart.
    given = rows.withColumn("_taken", F.col("_owner").isNotNull()).na.fill(0, ["_owner"])
    bids = given.groupBy("_task").applyInPandas(_bid, _STATE)
    best = bids.groupBy("_group", "_o").agg(F.max(F.struct("_price", "_left", "_owner")).alias("_b"))
    had = F.struct("_price", "_left", "_owner")
    merged = state.join(best, ["_group", "_o"], "left").select("_group", "_o", F.coalesce("_b", had).alias("_b"))
    merged = cut_lineage(merged.select("_group", "_o", "_b.*"), "prices")
    owned = merged.groupBy("_group").agg(F.count("_owner").alias("_owned"), F.max("_left").alias("_now"))
    full = F.col("_owned") == F.col("_bidders")
    after = owned.join(sizes.select("_group", "_bidders"), "_group").select(
        "_group", "_now", (full & (F.col("_now") == 0)).alias("_done"), (full & (F.col("_now") > 0)).alias("_again")
    )
    return merged.join(after, "_group").select(
        "_group",
        "_o",
        "_price",
        F.when(~F.col("_again"), F.col("_owner")).alias("_owner"),
        (F.col("_now") - F.col("_again").cast("int")).alias("_left"),
        "_done",
    )


def _bid(rows: pd.DataFrame) -> pd.DataFrame:
    """The options of one task that took a bid, with their new price and owner."""
    out = []
    for group, part in rows.groupby("_group", sort=False):
        bidders, whole = int(part["_bidders"].iat[0]), int(part["_pieces"].iat[0]) == 1
        unit = (bidders + 1) << 32
        choices: dict[int, list[tuple[int, int]]] = {}
        price: dict[int, int] = {}
        owner: dict[int, int] = {}
        for p, o, cost, tie, paid, taken, had in zip(
            *(part[c] for c in ("_p", "_o", "cost", "_tie", "_price", "_taken", "_owner")), strict=True
        ):
            worth = 0 if pd.isna(cost) else ((UNMATCHED_COST - int(cost)) * unit - int(tie)) * (bidders + 1)
            choices.setdefault(int(p), []).append((int(o), worth))
            price[int(o)] = int(paid)
            if taken:
                owner[int(o)] = int(had)
        left = part["_left"].iat[0]
        if pd.isna(left):
            left, coarsest = 0, UNMATCHED_COST * unit * (bidders + 1) // 2
            while FINER ** (left + 1) < coarsest:
                left += 1
        left = int(left)
        touched = _settle(choices, price, owner, FINER**left)
        while whole and left:
            left -= 1
            owner.clear()
            touched |= _settle(choices, price, owner, FINER**left)
        out += [(group, o, Decimal(price[o]), owner[o], left) for o in touched]
    return pd.DataFrame(out, columns=["_group", "_o", "_price", "_owner", "_left"])


def _settle(choices: dict[int, list[tuple[int, int]]], price: dict[int, int], owner: dict[int, int], step: int) -> set[int]:
    """Bid until every bidder of ``choices`` owns an option; ``price`` and ``owner`` follow.  Returns the options bid for."""
    owning = set(owner.values())
    free = sorted(p for p in choices if p not in owning)
    touched = set()
    while free:
        p = free.pop()
        best = second = None
        for o, worth in choices[p]:
            net = (worth - price[o], o)
            if best is None or net > best:
                best, second = net, best
            elif second is None or net > second:
                second = net
        o = best[1]
        price[o] += best[0] - second[0] + step
        beaten = owner.get(o)
        owner[o] = p
        touched.add(o)
        if beaten in choices:
            free.append(beaten)
    return touched


def _with_groups(edges: DataFrame) -> DataFrame:
    """Edges with the label of their connected group."""
    labels = components(edges.select(F.col("_n").alias("u"), F.col("_c").alias("v")))
    return edges.join(labels.select(F.col("node").alias("_n"), F.col("label").alias("_group")), "_n")
