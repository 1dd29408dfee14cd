"""Author popularity: views per author, the top-k list per window, each user's
share of it, and whether a user is an author.

* ``author_views``: ``groupBy(window, author).count()`` -- map-side combined, so
  a hot author costs one partial row per task.
* ``top_authors``: ``row_number`` over ``(window)`` ordered by views desc, then
  author id (lower id wins a tie), filtered ``<= k``.  Catalyst turns the
  filter into a per-partition group limit *below* the shuffle, so each
  window's final sort sees at most ``k`` rows per input partition.
* ``author_attraction``: distinct (user, author) pairs semi-joined with the
  top list.  The list has at most ``k x windows`` rows, a bound known before
  the job runs, so it is broadcast.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.weights import HORIZONS, TOP_AUTHORS
from .affinity import AUTHOR, VIDEO, item_day_sets, item_sets, item_weights, max_item_affinity
from .windows import FeatureWindow, in_span

#: Authors in one list of ``user_author_chunks``, about.
AUTHORS_IN_CHUNK = 4096


def author_views(activity: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``(window_id, author_id, views)`` over every activity row of the window
    (including users outside the spine).  One aggregate keyed by the author
    with one conditional count per window, then one row per window with views."""
    day = F.col("day")
    per_author = (activity.where(in_span(windows) & F.col("author_id").isNotNull())
                  .groupBy("author_id")
                  .agg(*[F.sum(F.when(day.between(w.feat_begin, w.feat_end), 1).otherwise(0))
                         .cast("long").alias(f"v{w.window_id}") for w in windows]))
    rows = F.array(*[F.struct(F.lit(w.window_id).alias("window_id"),
                              F.col(f"v{w.window_id}").alias("views")) for w in windows])
    return (per_author.select("author_id", F.inline(rows))
            .where(F.col("views") > 0)
            .select("window_id", "author_id", "views"))


def top_authors(views: DataFrame, k: int = TOP_AUTHORS) -> DataFrame:
    """``(window_id, author_id, views, author_rank)`` for the ``k`` most viewed."""
    order = Window.partitionBy("window_id").orderBy(F.desc("views"), F.asc("author_id"))
    return (views.withColumn("author_rank", F.row_number().over(order))
            .where(F.col("author_rank") <= k))


def top_author_flags(top: DataFrame) -> DataFrame:
    """Broadcastable ``(window_id, author_id, is_top)``; size <= k x windows."""
    return F.broadcast(top.select("window_id", "author_id", F.lit(1).alias("is_top")))


def author_block(activity: DataFrame, windows: Sequence[FeatureWindow],
                 k: int = TOP_AUTHORS, views: DataFrame | None = None) -> DataFrame:
    """Author affinity (full window + horizons) and the top-k attraction share,
    from one (window, user, author) aggregate.  Pass ``views`` when the
    caller also needs them, so the plan computes them once."""
    sets = item_day_sets(activity, windows, "author_id")
    if views is None:
        views = author_views(activity, windows)
    top = top_author_flags(top_authors(views, k))
    flagged = sets.join(top, ["window_id", "author_id"], "left")
    share = (F.count(F.col("is_top")) / F.lit(float(k))).alias("author_atttractive_force")
    return max_item_affinity(flagged, "user_view_same_author_weight",
                             "user_view_same_author_{i}_weight", extra_aggs=[share])


def grain_views(grain: DataFrame, windows: Sequence[FeatureWindow]) -> DataFrame:
    """``author_views`` from the item grain.  Videos fall into the null group, with no views, and drop out;
    neither they nor null authors are filtered by a key, as that would move below the grain's aggregate and split it."""
    views = [F.expr(f"sum(CASE WHEN kind = '{AUTHOR}' AND item IS NOT NULL AND m{w.window_id} IS NOT NULL "
                    f"THEN c{w.window_id} ELSE 0 END) AS v{w.window_id}") for w in windows]
    rows = ", ".join(f"named_struct('window_id', {w.window_id}, 'views', v{w.window_id})" for w in windows)
    author = f"CASE WHEN kind = '{AUTHOR}' THEN item END"
    return (grain.groupBy(F.expr(author).alias("author")).agg(F.max(F.expr(author)).alias("author_id"), *views)
            .selectExpr("author_id", f"inline(array({rows}))").where("views > 0")
            .select("window_id", "author_id", "views"))


def item_block(grain: DataFrame, windows: Sequence[FeatureWindow], views: DataFrame, k: int = TOP_AUTHORS) -> DataFrame:
    """Video and author affinity and the top-k attraction share, one aggregate per (window, user)."""
    top = top_author_flags(top_authors(views, k)).withColumnRenamed("author_id", "item").withColumn("kind", F.lit(AUTHOR))
    weights = item_sets(grain, windows).join(top, ["window_id", "kind", "item"], "left").selectExpr("*", *item_weights())
    aggs = []
    for kind, full, horizon in ((VIDEO, "weight_user_view_video_weight", "weight_user_view_video_{i}_weight"),
                                (AUTHOR, "user_view_same_author_weight", "user_view_same_author_{i}_weight")):
        aggs.append(f"max(CASE WHEN kind = '{kind}' THEN w_all END) AS {full}")
        aggs += [f"max(CASE WHEN kind = '{kind}' AND w_{i} > 0 THEN w_{i} END) AS {horizon.format(i=i)}" for i in HORIZONS]
    aggs.append(f"count(is_top) / {float(k)!r}D AS author_atttractive_force")
    return weights.groupBy("window_id", "user_id").agg(*[F.expr(a) for a in aggs])


def author_flags(views: DataFrame) -> DataFrame:
    """``(window_id, user_id, user_is_author)``: the user was viewed as an author
    in the window.  Keyed like the feature blocks; joined, never broadcast
    (its size grows with the number of authors)."""
    return views.select("window_id", F.col("author_id").alias("user_id"),
                        F.lit(1).alias("user_is_author"))


def user_author_chunks(activity: DataFrame, windows: Sequence[FeatureWindow], chunk: int = AUTHORS_IN_CHUNK) -> DataFrame:
    """``(window_id, user_id, chunk, authors)``: all authors a user viewed, in sorted lists of about ``chunk``.

    Authors are dealt to a user's chunks by hash, as many chunks as the user's number of authors asks for,
    so no user, however active, needs one list or one task.  Rows without an author are left out.
    Only users with more than ``chunk`` authors meet in the join; a hot one is split there by AQE.
    """
    keys = ["window_id", "user_id"]
    pairs = item_day_sets(activity.where(F.col("author_id").isNotNull()), windows, "author_id").drop("days")
    many = (pairs.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > chunk)
            .select(*keys, F.ceil(F.col("n") / chunk).alias("chunks")))
    dealt = pairs.join(many, keys, "left").withColumn(
        "chunk", F.coalesce(F.expr("pmod(xxhash64(author_id), chunks)"), F.lit(0)).cast("int"))
    return dealt.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list("author_id")).alias("authors"))


def user_top_authors(activity: DataFrame, windows: Sequence[FeatureWindow],
                     k: int = TOP_AUTHORS) -> DataFrame:
    """``(window_id, user_id, top_authors_viewed)``: sorted popular authors the
    user viewed.  The per-user list is bounded by ``k`` (it is taken after the
    semi-join with the top list), so collecting it is safe for any user."""
    pairs = item_day_sets(activity, windows, "author_id")
    top = top_author_flags(top_authors(author_views(activity, windows), k))
    return (pairs.join(top, ["window_id", "author_id"], "left_semi")
            .groupBy("window_id", "user_id")
            .agg(F.array_sort(F.collect_set("author_id")).alias("top_authors_viewed")))
