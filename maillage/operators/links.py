"""Links between persons and structures after structures were merged.

``links``: id, personne_id, structure_id, type, structure_coop_id, mediateur_coop_id,
suppression (close date, NULL while open).
``pairs``: winner_id, loser_id, loser_coop_id; resolved, so no id is on both sides.

Each step looks at the table as it stood before the step. All steps work on every
pair at once. Which partner row fills a gap is settled by the smallest id, and each
match is made against one aggregated row per key, so no step lists pairs of rows.
``now`` stamps ``updated_at`` on the rows a step changes.

Internally the rows carry the winner they belong to (``_side``) and their part in the
merge (``_part``: winner, loser, orphan). The steps work on rows with a part only; a merge
touches few structures, so most of the table passes by.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.operators.joins import flag_matches, join_unique, null_safe_join
from maillage.operators.ordering import neutralise_rest
from maillage.session import cut

SLOT = ["_side", "personne_id", "type", "suppression"]
WHO = ["_side", "personne_id", "type"]
COOPS = ("structure_coop_id", "mediateur_coop_id")


def _is(part: str) -> Column:
    return F.col("_part").eqNullSafe(part)


def _ends(pairs: DataFrame) -> DataFrame:
    """What a link is recognised by: the ids of winner and loser, and the loser's external id."""

    def end(key: Column, part: str) -> Column:
        return F.struct(key.alias("_key"), F.col("winner_id").alias("_side"), F.lit(part).alias("_part"))

    return (
        pairs.select(F.inline(F.array(
            end(_id_key(F.col("winner_id")), "winner"),
            end(_id_key(F.col("loser_id")), "loser"),
            end(_coop_key(F.col("loser_coop_id")), "orphan"),
        )))
        .where("_key is not null")
        .distinct()
    )


def _id_key(column: Column) -> Column:
    return F.concat(F.lit("id "), column.cast("string"))


def _coop_key(column: Column) -> Column:
    return F.concat(F.lit("coop "), column.cast("string"))


def _keyed(links: DataFrame) -> DataFrame:
    """A link goes by its structure, or without one by its external id: one key, so one shuffle."""
    return links.withColumn("_key", F.coalesce(_id_key(F.col("structure_id")), _coop_key(F.col("structure_coop_id"))))


def _touched(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links of a merge, with ``_side`` and ``_part``. An orphan has no structure but a loser's external id."""
    return _keyed(links).join(_ends(pairs), "_key").select(*links.columns, "_side", "_part")


def _untouched(links: DataFrame, pairs: DataFrame) -> DataFrame:
    return _keyed(links).join(_ends(pairs).select("_key"), "_key", "left_anti").select(*links.columns)


def _change(df: DataFrame, cond: Column, new: Mapping[str, Column], now: Column | None, keep: list[str]) -> DataFrame:
    new = dict(new)
    if now is not None and "updated_at" in keep:
        new["updated_at"] = now
    hit = F.coalesce(cond, F.lit(False))
    return df.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in keep])


def _no_coops(rows: DataFrame) -> dict[str, Column]:
    return {c: F.lit(None).cast(rows.schema[c].dataType) for c in COOPS}


def _gap_fill(offers: Column) -> list[Column]:
    """For either external id, the value of the smallest row id that has one, among the rows in ``offers``."""
    return [F.min_by(c, F.when(offers & F.col(c).isNotNull(), F.col("id"))).alias(f"_f_{c}") for c in COOPS]


def _filled() -> dict[str, Column]:
    return {c: F.coalesce(c, f"_f_{c}") for c in COOPS}


def _collision(rows: DataFrame, now: Column | None) -> DataFrame:
    keys = ["_side", "type", "suppression", *COOPS]
    flagged = flag_matches(rows, rows.where(_is("loser")), keys, "_hit")
    return _change(flagged, _is("winner") & F.col("_hit"), _no_coops(rows), now, rows.columns)


def _orphan_collision(rows: DataFrame, now: Column | None) -> DataFrame:
    keys = ["_side", "mediateur_coop_id", "type", "suppression"]
    flagged = flag_matches(rows, rows.where(_is("orphan")), keys, "_hit")
    return _change(flagged, _is("winner") & F.col("_hit"), _no_coops(rows), now, rows.columns)


def _fold(rows: DataFrame, now: Column | None) -> DataFrame:
    # One aggregate finds the keys that both sides hold, and what the loser's rows offer.
    matched = (
        rows.where(_is("winner") | _is("loser"))
        .groupBy(*SLOT)
        .agg(F.bool_or(_is("winner")).alias("_w"), F.bool_or(_is("loser")).alias("_l"), *_gap_fill(_is("loser")))
        .where("_w and _l")
    )
    joined = null_safe_join(rows, matched, SLOT, "left")
    hit = F.col("_w").isNotNull()
    return _change(joined.where(~(hit & _is("loser"))), hit & _is("winner"), _filled(), now, rows.columns)


def _repoint(rows: DataFrame, now: Column | None) -> DataFrame:
    flagged = flag_matches(rows, rows.where(_is("winner")), SLOT, "_taken")
    moved = {"structure_id": F.col("_side"), "_part": F.lit("winner")}
    return _change(flagged, _is("loser") & ~F.col("_taken"), moved, now, rows.columns)


def _attach(rows: DataFrame, now: Column | None) -> DataFrame:
    winners = rows.where(_is("winner"))
    equal = flag_matches(rows, winners, [*SLOT, *COOPS], "_equal")
    placed = flag_matches(equal.where(~(_is("orphan") & F.col("_equal"))), winners, SLOT, "_taken")
    moved = {"structure_id": F.col("_side"), "_part": F.lit("winner")}
    return _change(placed, _is("orphan") & ~F.col("_taken"), moved, now, rows.columns)


def _close_dates(
    rows: DataFrame, table: DataFrame, closed: DataFrame, now: Column | None, outdated: DataFrame | None = None
) -> DataFrame:
    """Any closed row can block a date: those of ``rows``, and those of ``table`` but for the ids ``outdated``."""
    dated = join_unique(rows, closed, WHO, "left")
    is_open, is_closed = F.col("suppression").isNull(), F.col("suppression").isNotNull()
    at_date = F.col("suppression") == F.col("_closed")
    facts = (
        dated.where(_is("winner") & F.col("_closed").isNotNull())
        .groupBy(*WHO)
        .agg(F.bool_or(at_date).alias("_has_closed"), F.bool_or(is_open).alias("_has_open"), *_gap_fill(is_open))
    )
    marked = join_unique(dated, facts, WHO, "left").withColumns({
        "_open": _is("winner") & is_open & F.col("_closed").isNotNull(),
        "_has_closed": F.coalesce("_has_closed", F.lit(False)),
    })

    # Only the dates that open rows would take are looked up in the table.
    same = ["type", "_closed", *COOPS]
    wanted = marked.where("_open and not _has_closed").select(*same).distinct()
    candidates = table.where(is_closed).withColumn("_closed", F.col("suppression")).select("id", *same)
    blocking = null_safe_join(candidates, wanted, same, "left_semi")
    if outdated is not None:
        blocking = blocking.join(outdated, "id", "left_anti")
    blocking = blocking.select(*same).unionByName(rows.where(is_closed).withColumn("_closed", F.col("suppression")).select(*same))
    marked = flag_matches(marked, blocking, same, "_blocked")

    takes_ids = F.coalesce(_is("winner") & at_date & F.col("_has_open"), F.lit(False))
    takes_date = F.col("_open") & ~F.col("_blocked")
    new = {
        **{c: F.when(takes_ids, F.coalesce(c, f"_f_{c}")).otherwise(F.col(c)) for c in COOPS},
        "suppression": F.when(takes_date, F.col("_closed")).otherwise(F.col("suppression")),
    }
    kept = marked.where(~(F.col("_open") & F.col("_has_closed")))
    return _change(kept, takes_ids | takes_date, new, now, rows.columns)


def _collapse(rows: DataFrame, now: Column | None) -> DataFrame:
    is_open = F.col("suppression").isNull()
    matched = (
        rows.where(_is("winner"))
        .groupBy(*WHO)
        .agg(F.bool_or(is_open).alias("_o"), F.bool_or(~is_open).alias("_c"), *_gap_fill(is_open))
        .where("_o and _c")
    )
    joined = join_unique(rows, matched, WHO, "left")
    hit = F.col("_o").isNotNull() & _is("winner")
    return _change(joined.where(~(hit & is_open)), hit, _filled(), now, rows.columns)


def _guard(rows: DataFrame, now: Column | None) -> DataFrame:
    """Rows of a survivor are held against each other, rows without a structure against those of all survivors."""
    keys = ["structure_coop_id", "mediateur_coop_id", "type", "suppression"]
    lone = F.col("structure_id").isNull()
    scope = F.col("structure_coop_id").isNotNull() & (_is("winner") | lone)
    placed = rows.withColumn("_holder", F.when(~lone, F.col("_side")))
    guarded = neutralise_rest(placed, [*keys, "_holder"], [], "id", ["structure_coop_id"], scope, now)
    marked = flag_matches(guarded.where(lone & F.col("structure_coop_id").isNotNull()), guarded.where(scope & ~lone), keys, "_held")
    freed = _change(marked, F.col("_held"), {"structure_coop_id": F.lit(None).cast(rows.schema["structure_coop_id"].dataType)}, now, rows.columns)
    return guarded.where(~lone | F.col("structure_coop_id").isNull()).select(*rows.columns).unionByName(freed)


def _closed(rows: DataFrame) -> DataFrame:
    return rows.where(_is("loser") & F.col("suppression").isNotNull()).groupBy(*WHO).agg(F.max("suppression").alias("_closed"))


def _alone(step: Callable, links: DataFrame, pairs: DataFrame, now: Column | None) -> DataFrame:
    return _untouched(links, pairs).unionByName(step(_touched(links, pairs), now).select(*links.columns))


def links_collision_null(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """A winner row equal to a loser row on (type, close date, both external ids) loses its external ids."""
    return _alone(_collision, links, pairs, now)


def links_orphan_collision_null(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """The same against rows without a structure that carry the loser's external id."""
    return _alone(_orphan_collision, links, pairs, now)


def links_fold_pairs(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """Winner and loser rows of one (person, type, close date): the loser's go, the winner's take their ids."""
    return _alone(_fold, links, pairs, now)


def links_repoint_rest(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """Loser rows without an equal (person, type, close date) row of the winner move to the winner."""
    return _alone(_repoint, links, pairs, now)


def links_attach_orphans(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows without a structure that carry a loser's external id: equal ones go, free ones join the winner."""
    return _alone(_attach, links, pairs, now)


def closed_of_losers(links: DataFrame, pairs: DataFrame) -> DataFrame:
    """Close dates to remember before the losers' rows are folded: latest per (winner, person, type)."""
    return _closed(_touched(links, pairs))


def links_keep_close_dates(links: DataFrame, pairs: DataFrame, closed: DataFrame, now: Column | None = None) -> DataFrame:
    """Open winner rows take the latest close date the loser had for the same person and type.

    If the winner already has a row closed on that date, that row takes the open row's
    ids and the open row goes. If any other row has the same type, date and external
    ids, the open row is left as it is.
    """
    return _alone(lambda rows, stamp: _close_dates(rows, links, closed, stamp), links, pairs, now)


def links_collapse_active_closed(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """Per winner, person and type: closed rows absorb the ids of the open rows, which go."""
    return _alone(_collapse, links, pairs, now)


def links_dedupe_guard(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """On (both external ids, type, close date) one row keeps its structure's external id.

    Of the rows of one survivor the smallest id keeps it. A row without a structure keeps it only where no row of any
    survivor has the same key, and it is the smallest of its kind. Rows of different survivors leave each other alone.
    Groups without a structure id have nothing to lose and are left out.
    """
    rows = _untouched(links, pairs).unionByName(_touched(links, pairs), allowMissingColumns=True)
    return _guard(rows, now).select(*links.columns)


def merge_links(links: DataFrame, pairs: DataFrame, now: Column | None = None) -> DataFrame:
    """All steps in their order, on the rows that take part.

    Every step reads its input more than once, so each result is cut; what is written
    are the rows of the merged structures and never the whole table. The whole table is
    shuffled three times: to find those rows, to look up close dates, to put it together.
    """
    first = rows = cut(_touched(links, pairs))
    closed = _closed(rows)
    for step in (_collision, _orphan_collision, _fold, _repoint, _attach):
        rows = cut(step(rows, now))
    rows = cut(_close_dates(rows, links, closed, now, first.select("id")))
    rows = cut(_collapse(rows, now))
    return _guard(_untouched(links, pairs).unionByName(rows, allowMissingColumns=True), now).select(*links.columns)
