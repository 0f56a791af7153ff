"""Near copies by SpotSigs: signature sets joined by length partitions, on built-in functions alone.

Sets can only be alike if their sizes are, so they are dealt into partitions of
set length, as wide as the wanted likeness allows: a set meets those of its own
partition and of the next one. There it is posted under its rarest signatures,
as many as two sets that are alike cannot all miss. Members of a posting are
first held against single ones of them, in rounds; what that does not already
join is compared in blocks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.common import in_block_pairs, saved, sifted_by_join
from lakeweir.llm.graph import components
from lakeweir.llm.spotsigs import with_signatures

#: Members of a posting that one block holds.
BLOCK_MEMBERS = 1000
#: Rounds in which one member of each posting is held against the others, at most.
MOST_ROUNDS = 12
#: Longest set that the partitions cover.
MOST_SIGNATURES = 1 << 31


def length_borders(percent: int) -> list[int]:
    """The least set size of each partition.

    The largest partner of a set is in its own partition or the next one.
    """
    borders = [1]
    while borders[-1] < MOST_SIGNATURES:
        borders.append(100 * borders[-1] // percent + 1)
    return borders


def _alike_sizes(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100L * least({a}, {b}) >= {percent}L * greatest({a}, {b})")


def _may_be_first(n_a: str, pos_a: str, n_b: str, pos_b: str, percent: int) -> Column:
    """Whether two sets can be alike if this is the first signature, by rarity, that they share."""
    most = f"least({n_a} - {pos_a}, {n_b} - {pos_b})"
    return F.expr(f"{100 + percent}L * {most} >= {percent}L * ({n_a} + {n_b})")


def postings(sets: DataFrame, percent: int) -> DataFrame:
    """``(k, sign, guest, set_key, n, pos)``: each set under its rarest signatures.

    ``k`` is the length partition; a set is a ``guest`` in the one before its
    own. ``pos`` counts the rarer signatures of the set. Signatures of one set
    alone take their places in that order but need no posting.
    """
    spots = sets.select("set_key", "n", F.explode("signs").alias("sign"))
    counts = saved(spots.groupBy("sign").agg(F.count("*").alias("held_by")).where("held_by > 1"), "spot-counts")
    ranked = spots.join(counts, "sign").groupBy("set_key", "n").agg(F.array_sort(F.collect_list(F.struct("held_by", "sign"))).alias("spots"))
    own = "(n - size(spots))"
    prefix = f"(n - ({percent} * n + 99) div 100 + 1)"
    borders = F.array(*[F.lit(b).cast("long") for b in length_borders(percent)])
    ranked = ranked.where(f"{prefix} > {own}").select(
        "set_key",
        "n",
        F.expr(own).alias("own"),
        (F.size(F.filter(borders, lambda b: b <= F.col("n"))) - 1).alias("home"),
        F.expr(f"slice(spots, 1, cast({prefix} - {own} AS INT))").alias("spots"),
    )
    posted = ranked.select("set_key", "n", "own", "home", F.posexplode("spots").alias("rank", "spot"))
    seats = F.array(F.struct(F.col("home").alias("k"), F.lit(False).alias("guest")), F.struct((F.col("home") - 1).alias("k"), F.lit(True).alias("guest")))
    posted = posted.select("set_key", "n", (F.col("own") + F.col("rank")).alias("pos"), F.col("spot.sign").alias("sign"), F.explode(seats).alias("seat"))
    return posted.select("seat.k", "sign", "seat.guest", "set_key", "n", "pos").where("k >= 0")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` of set keys whose Jaccard similarity is at least ``percent`` in a hundred.

    Pairs are read three times. Of the sets, those move that are in a pair, and few others.
    """
    ends = pairs.select(F.explode(F.array("u", "v")).alias("end"))
    sets = sifted_by_join(sets, "set_key", ends, "end")
    a = sets.select(F.col("set_key").alias("u"), F.col("signs").alias("a"))
    b = sets.select(F.col("set_key").alias("v"), F.col("signs").alias("b"))
    common = "size(array_intersect(a, b))"
    return pairs.join(a, "u").join(b, "v").where(f"100L * {common} >= {percent}L * (size(a) + size(b) - {common})").select("u", "v")


def _open(members: DataFrame) -> DataFrame:
    """``(k, sign, members, pairs)``: the postings whose members are not all joined, with the pairs that are left in them."""
    parts = members.groupBy("k", "sign", "root").agg(F.count("*").alias("c"), F.count(F.when(~F.col("guest"), 1)).alias("own"))
    parts = parts.groupBy("k", "sign").agg(F.sum("c").alias("members"), F.sum("own").alias("own"), F.sum(F.expr("c * c")).alias("joined"), F.count("*").alias("parts"))
    parts = parts.where("parts > 1 AND own > 0")
    return saved(parts.select("k", "sign", "members", F.expr("(members * members - joined) div 2").alias("pairs")), "spot-open")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Verified links between unlike sets, enough to join all that any link joins.

    In each round one member of a posting, drawn by hash, is held against those
    that no link joins to it, and leaves the posting. Rounds end when few pairs
    are open, or after :data:`MOST_ROUNDS`; what is open then meets in blocks.
    """
    bucket = ["k", "sign"]
    members = saved(postings(sets, percent).withColumn("root", F.col("set_key")), "spot-postings")
    left_open = _open(members)
    n_members = members.count()
    joined = None
    for turn in range(MOST_ROUNDS):
        if turn and (left_open.agg(F.sum("pairs")).first()[0] or 0) <= n_members:
            break
        members = members.join(left_open.select(*bucket), bucket)
        drawn = F.struct(F.xxhash64("set_key", F.lit(turn)).alias("draw"), "set_key", "n", "pos", "root")
        heads = saved(members.where("NOT guest").groupBy(bucket).agg(F.min(drawn).alias("head")), "spot-heads")
        members = saved(members.join(heads, bucket).where("set_key <> head.set_key"), "spot-members")
        pairs = members.where("root <> head.root").where(
            _alike_sizes("n", "head.n", percent) & _may_be_first("n", "pos", "head.n", "head.pos", percent)
        )
        pairs = pairs.select(F.least("set_key", "head.set_key").alias("u"), F.greatest("set_key", "head.set_key").alias("v"))
        found = verified(saved(pairs.distinct(), "spot-pairs"), sets, percent)
        joined = saved(found if joined is None else joined.unionByName(found), "spot-links")
        roots = saved(components(joined, "u", "v").withColumnRenamed("root", "now"), "spot-roots")
        members = members.drop("head", "root").join(roots, F.col("set_key") == F.col("id"), "left")
        members = saved(members.withColumn("root", F.coalesce("now", "set_key")).drop("id", "now"), "spot-members")
        left_open = _open(members)

    dealt = in_block_pairs(members.join(left_open, bucket), "set_key", F.ceil(F.col("members") / BLOCK_MEMBERS))
    keys = [*bucket, "lo", "hi"]
    columns = ["block", "guest", "set_key", "n", "pos", "root"]
    dealt = dealt.select(*keys, *columns)
    right = dealt.select(*keys, *[F.col(c).alias(f"{c}_b") for c in columns])
    second = dealt.where("NOT guest").join(right, keys).where("root <> root_b AND (lo = hi OR block <> block_b) AND (guest_b OR set_key < set_key_b)")
    second = second.where(_alike_sizes("n", "n_b", percent) & _may_be_first("n", "pos", "n_b", "pos_b", percent))
    second = second.select(F.least("set_key", "set_key_b").alias("u"), F.greatest("set_key", "set_key_b").alias("v"))
    return joined.unionByName(verified(saved(second.distinct(), "spot-pairs"), sets, percent))


def similar_spots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """``(doc_id, n_signatures, component_id)``: what each document is joined to by like signatures.

    Two documents link when their sets of signatures (see
    :func:`~lakeweir.llm.spotsigs.with_signatures`) have a Jaccard similarity of
    at least ``percent`` in a hundred, from 50 to 99. ``component_id`` is the
    smallest id that links lead to. Equal sets are one set in the join, so
    copies cost nothing there; pairs that other links already join are not
    compared. A member of a posting is copied once for each block of the
    posting, so a signature that is among the rarest of very many unlike sets
    costs the square of their number.

    A null or empty text has no signatures and links with nothing. A null id is
    no component's id unless all of its members have null; repeated rows and ids
    each keep their own row. An empty table gives no rows; other columns are not
    read. Sets are told apart by 64 bits.
    """
    if not 50 <= percent < 100:
        raise ValueError(f"percent must be from 50 to 99, not {percent}")
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = with_signatures(named, "text", "signs")
    rows = saved(rows.select("doc_id", "signs", F.size("signs").alias("n"), F.when(F.size("signs") > 0, F.xxhash64("signs")).alias("set_key")), "spots")
    # A smaller set is like no other set but itself.
    least = -(-percent // (100 - percent))
    sets = saved(rows.where(F.col("n") >= least).groupBy("set_key").agg(F.any_value("n").alias("n"), F.any_value("signs").alias("signs")), "spot-sets")
    roots = components(saved(_links(sets, percent), "spot-links"), "u", "v")
    classes = rows.select("doc_id", "n", "set_key").join(roots, F.col("set_key") == F.col("id"), "left")
    classes = saved(classes.select("doc_id", "n", F.coalesce("root", "set_key").alias("root")), "spot-classes")
    smallest = saved(classes.where("root IS NOT NULL").groupBy(F.col("root").alias("to")).agg(F.min("doc_id").alias("least")), "spot-least")
    out = classes.join(smallest, F.col("root") == F.col("to"), "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_signatures"), component.alias("component_id"))
