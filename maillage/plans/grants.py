"""Funded positions: contracts, grants, payments, and their summary."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.functions import label_enveloppes, net_v2, zero_if_null
from maillage.operators.joins import join_unique
from maillage.session import cut

# Wide enough not to round an amount that a double states; sums in it do not depend on the order of the rows.
MONEY = "decimal(28,8)"
PAIR = ["poste_conum_id", "structure_id"]
GRANT_COLUMNS = [
    "enveloppes", "date_fin_convention", "is_territoire_prioritaire", "montant_subvention_v1", "montant_bonification_v1",
    "montant_subvention_v2", "montant_bonification_v2", "montant_subvention_cumule",
]
PAYMENT_COLUMNS = ["montant_versement_cumule", "versement_cumule_v1", "versement_cumule_v2"]


def contrats_par_personne(contrat: DataFrame) -> DataFrame:
    """Per (person, structure): contracts in force, and the latest end date of any contract."""
    return contrat.where("personne_id is not null and structure_id is not null").groupBy("personne_id", "structure_id").agg(
        F.count_distinct(F.when(F.col("date_rupture").isNull(), F.col("id"))).alias("nb_contrats_en_cours"),
        F.max("date_fin").alias("date_fin_contrat"),
        F.lit(True).alias("_contrat"),
    )


POSTE = ["id", "personne_id", "etat", "typologie", "nb_contrats_en_cours", "date_fin_contrat", "_contrat"]


def _postes_with_contracts(poste: DataFrame, contrat: DataFrame) -> DataFrame:
    """Positions with the facts about their person's contracts.

    Contracts are aggregated before they meet the positions, so the join does not fan
    out and serves the choice, the number in force and the last end date at once.
    """
    return join_unique(poste, contrats_par_personne(contrat), ["personne_id", "structure_id"], "left")


def _choice() -> Column:
    """The row to keep of a pair, as one value whose maximum is it.

    A contract in force first, then the newest attribution (absent dates last), then the
    newest creation (absent dates first), then the smallest id. A maximum combines on
    the map side, so a pair with very many positions is one row per task.
    """
    order = F.struct(
        (F.coalesce("nb_contrats_en_cours", F.lit(0)) > 0).alias("_en_cours"),
        "date_attribution",
        F.col("created_at").isNull().alias("_sans_date"),
        "created_at",
        (-F.col("id")).alias("_rang"),
        *POSTE,
    )
    return F.max(order).alias("_poste")


def _chosen_postes(poste: DataFrame, contrat: DataFrame) -> DataFrame:
    """One position per pair; a NULL structure is a pair of its own."""
    chosen = _postes_with_contracts(poste, contrat).groupBy(*PAIR).agg(_choice())
    return chosen.select(*PAIR, *[f"_poste.{c}" for c in POSTE])


def poste_par_structure(poste: DataFrame, contrat: DataFrame) -> DataFrame:
    """One position per (position number, structure): with a contract in force first, then the newest.

    An absent creation date counts as newest; the smallest id settles what is left open.
    """
    return _chosen_postes(poste, contrat).select("id", *PAIR, "personne_id", "etat", "typologie")


def contrats_en_cours(poste: DataFrame, contrat: DataFrame) -> DataFrame:
    """Contracts in force per pair; pairs without any are left out."""
    return _chosen_postes(poste, contrat).where("nb_contrats_en_cours > 0").select(*PAIR, "nb_contrats_en_cours")


def dernier_contrat(poste: DataFrame, contrat: DataFrame) -> DataFrame:
    """Latest contract end per pair, broken contracts included; NULL where no contract has an end."""
    return _chosen_postes(poste, contrat).where("_contrat").select(*PAIR, F.col("date_fin_contrat").alias("date_fin"))


def _amounts() -> list[Column]:
    """Grant and payment columns of one grant, missing amounts counting as 0."""
    v1, v2, bonus = (F.col(c) for c in ("montant_subvention_v1", "montant_subvention_v2", "montant_bonification_v2"))
    paid_v1 = zero_if_null(F.col("montant_versement_v1"))
    paid_v2 = sum((zero_if_null(F.col(f"versement_{i}_v2")) for i in (2, 3)), zero_if_null(F.col("versement_1_v2")))
    return [
        label_enveloppes(v1, v2).alias("enveloppes"),
        F.greatest("date_fin_convention_dgcl", "date_fin_convention_ditp", "date_fin_convention_dge").alias("date_fin_convention"),
        (zero_if_null(bonus) > 0).alias("is_territoire_prioritaire"),
        zero_if_null(v1).alias("montant_subvention_v1"),
        F.lit(0).alias("montant_bonification_v1"),
        net_v2(v2, bonus).alias("montant_subvention_v2"),
        zero_if_null(bonus).alias("montant_bonification_v2"),
        # The cumulative amount counts V2 with its bonus.
        (zero_if_null(v1) + zero_if_null(v2)).alias("montant_subvention_cumule"),
        (paid_v1 + paid_v2).alias("montant_versement_cumule"),
        paid_v1.alias("versement_cumule_v1"),
        paid_v2.alias("versement_cumule_v2"),
    ]


def grants_par_poste(subvention: DataFrame, poste: DataFrame) -> DataFrame:
    """One row per grant with the pair of its position, the grant columns and the payment columns."""
    return subvention.join(poste.select(F.col("id").alias("poste_id"), *PAIR), "poste_id").select(*PAIR, *_amounts())


def subventions_par_enveloppe(subvention: DataFrame, poste: DataFrame) -> DataFrame:
    return grants_par_poste(subvention, poste).select(*PAIR, *GRANT_COLUMNS)


def versements_cumules(subvention: DataFrame, poste: DataFrame) -> DataFrame:
    return grants_par_poste(subvention, poste).select(*PAIR, *PAYMENT_COLUMNS)


def _summed(grants: DataFrame) -> DataFrame:
    """One row per pair: all of its grants added up."""
    amounts = [c for c in GRANT_COLUMNS + PAYMENT_COLUMNS if c.startswith(("montant", "versement"))]
    has_v1, has_v2 = (F.bool_or(F.col("enveloppes").contains(v)) for v in ("V1", "V2"))
    return grants.groupBy(*PAIR).agg(
        label_enveloppes(F.when(has_v1, F.lit(1)), F.when(has_v2, F.lit(1))).alias("enveloppes"),
        F.max("date_fin_convention").alias("date_fin_convention"),
        F.bool_or("is_territoire_prioritaire").alias("is_territoire_prioritaire"),
        *[F.sum(c).alias(c) for c in amounts],
    )


@dataclass(frozen=True)
class FactorisedSummary:
    """The summary of positions before grants and payments of a pair are written out beside each other.

    ``pairs``: one row per pair, with its position and contracts. ``grants`` and ``payments``: the distinct ones of a
    pair with the number of times each occurs (``_n``, ``_m``). The view has every grant beside every payment; what is
    asked of it is computed from the three tables, whose rows do not multiply, and ``rows`` writes it out.
    """

    pairs: DataFrame
    grants: DataFrame
    payments: DataFrame

    def ending_before(self, before: date | str) -> FactorisedSummary:
        """The part of the view whose agreement ends before a date; pairs without such a grant are left out."""
        kept = self.grants.where(F.col("date_fin_convention") < F.lit(before).cast("date"))
        return FactorisedSummary(join_unique(self.pairs, kept.select(*PAIR).distinct(), PAIR, "left_semi"), kept, self.payments)

    def totals(self) -> DataFrame:
        """nb_lignes and the sums of the amounts over all rows that the view has: one row, from one row per pair."""
        times = {side: {c: F.sum(F.col(c).cast("decimal(38,0)") * F.col(n)).alias(c) for c in columns if c.startswith(("montant", "versement"))}
                 for side, columns, n in (("g", GRANT_COLUMNS, "_n"), ("p", PAYMENT_COLUMNS, "_m"))}
        granted = self.grants.groupBy(*PAIR).agg(F.sum("_n").alias("_n"), *times["g"].values())
        paid = self.payments.groupBy(*PAIR).agg(F.sum("_m").alias("_m"), *times["p"].values())
        funded = join_unique(join_unique(self.pairs.select(*PAIR), granted, PAIR, "left"), paid, PAIR, "left")
        lines = {"g": F.col("_m"), "p": F.col("_n")}  # a grant stands beside each payment, a payment beside each grant

        def total(column: str, side: str) -> Column:
            return F.coalesce(F.sum(F.col(column) * lines[side]), F.lit(0)).cast("decimal(38,0)")

        named = {name: (c, "g" if c in GRANT_COLUMNS else "p") for name, c in AMOUNTS.items()}
        return funded.agg(
            F.coalesce(F.sum(F.coalesce(F.col("_n") * F.col("_m"), F.lit(1))), F.lit(0)).cast("decimal(38,0)").alias("nb_lignes"),
            *[total(c, side).alias(name) for name, (c, side) in named.items()],
        )

    def rows(self) -> DataFrame:
        """Every grant of a pair beside every payment of the pair, as the view is defined; pairs without a grant once.

        The positions join the grants before the rows multiply, and the multiplying join comes last: it is an inner
        join, in which adaptive execution splits a hot pair on both sides, and nothing shuffles its result. Equal rows
        are written out at the very end, n times, then m, so no array is longer than the grants of one pair.
        """
        joined = join_unique(self.grants, self.pairs.where("_finance"), PAIR, "inner").join(self.payments, PAIR)
        for times in ("_n", "_m"):
            joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).drop("_copy")
        return _named(joined.drop("_n", "_m").unionByName(self.pairs.where("_finance is null"), allowMissingColumns=True))


# Amounts of the view, by the names it gives them.
AMOUNTS = {
    "montant_subvention_cumule": "montant_subvention_cumule", "montant_versement_cumule": "montant_versement_cumule", "subvention_v1": "montant_subvention_v1",
    "versement_cumule_v1": "versement_cumule_v1", "subvention_v2": "montant_subvention_v2", "bonification_v2": "montant_bonification_v2",
    "versement_cumule_v2": "versement_cumule_v2",
}


def postes_factorises(poste: DataFrame, contrat: DataFrame, subvention: DataFrame) -> FactorisedSummary:
    """The summary of positions in factorised form. Grants and pairs are read by several branches, so each is computed once and cut."""
    grants = cut(grants_par_poste(subvention, poste).dropna(subset=PAIR))
    funded = grants.select(*PAIR).distinct().withColumn("_finance", F.lit(True))
    pairs = cut(join_unique(_chosen_postes(poste, contrat), funded, PAIR, "left"))
    return FactorisedSummary(
        pairs, grants.groupBy(*PAIR, *GRANT_COLUMNS).agg(F.count("*").alias("_n")), grants.groupBy(*PAIR, *PAYMENT_COLUMNS).agg(F.count("*").alias("_m"))
    )


def postes_synthese(poste: DataFrame, contrat: DataFrame, subvention: DataFrame, collapse: bool = False) -> DataFrame:
    """Summary of positions: state, contracts, grants and payments per (position number, structure).

    A pair with n grants has n x n rows: grants and payments are joined to the pair
    independently. ``collapse=True`` adds them up to one row per pair instead. Pairs
    without a structure meet no grant and no contract. ``postes_factorises`` answers
    questions about the n x n rows without writing them out.
    """
    if not collapse:
        return postes_factorises(poste, contrat, subvention).rows()
    grants = grants_par_poste(subvention, poste).dropna(subset=PAIR)
    return _named(_chosen_postes(poste, contrat).join(_summed(grants), PAIR, "left"))


def _named(joined: DataFrame) -> DataFrame:
    """The columns of the view, absent amounts as 0."""
    zero = {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in GRANT_COLUMNS + PAYMENT_COLUMNS}
    return joined.select(
        "poste_conum_id",
        F.col("id").alias("poste_id"),
        "structure_id",
        "personne_id",
        "etat",
        "typologie",
        (F.col("typologie") == "coordo").alias("est_coordinateur"),
        "enveloppes",
        "date_fin_convention",
        "date_fin_contrat",
        F.coalesce("is_territoire_prioritaire", F.lit(False)).alias("bonification"),
        zero["montant_subvention_cumule"].alias("montant_subvention_cumule"),
        zero["montant_versement_cumule"].alias("montant_versement_cumule"),
        zero["montant_subvention_v1"].alias("subvention_v1"),
        F.coalesce("montant_bonification_v1", F.lit(0)).cast("int").alias("bonification_v1"),
        zero["versement_cumule_v1"].alias("versement_cumule_v1"),
        zero["montant_subvention_v2"].alias("subvention_v2"),
        zero["montant_bonification_v2"].alias("bonification_v2"),
        zero["versement_cumule_v2"].alias("versement_cumule_v2"),
        F.coalesce("nb_contrats_en_cours", F.lit(0).cast("bigint")).alias("nb_contrats_en_cours"),
    )


def total_subvention_v2(subvention: DataFrame) -> DataFrame:
    return subvention.agg(F.sum("montant_subvention_v2").alias("total_v2"))


def postes_par_etat(poste: DataFrame) -> DataFrame:
    return poste.groupBy("etat").agg(F.count("*").alias("nb_postes"))


def fenetre_contrat(synthese: DataFrame, before: date | str) -> DataFrame:
    """Positions whose agreement ends before a date."""
    return synthese.where(F.col("date_fin_convention") < F.lit(before).cast("date"))


def consommation_enveloppe(
    demande: DataFrame, action: DataFrame, feuille: DataFrame, enveloppe: DataFrame, plafond: DataFrame
) -> DataFrame:
    """Requested amount per department and envelope, against the envelope and the department's ceiling."""
    requested = (
        demande.select(F.col("action_id"), "enveloppe_financement_id", "subvention_demandee")
        .join(action.select(F.col("id").alias("action_id"), "feuille_de_route_id"), "action_id")
        .join(
            feuille.select(F.col("id").alias("feuille_de_route_id"), F.col("gouvernance_departement_code").alias("departement_code")),
            "feuille_de_route_id",
        )
        .groupBy("departement_code", F.col("enveloppe_financement_id").alias("enveloppe_id"))
        .agg(F.count("*").alias("nb_demandes"), F.sum(F.col("subvention_demandee").cast(MONEY)).alias("_demande"))
    )
    return (
        requested.join(enveloppe.select(F.col("id").alias("enveloppe_id"), F.col("montant").alias("montant_enveloppe")), "enveloppe_id")
        .join(plafond.select("departement_code", "enveloppe_id", "plafond"), ["departement_code", "enveloppe_id"], "left")
        .select(
            "departement_code", "enveloppe_id", "nb_demandes",
            F.col("_demande").cast("double").alias("montant_demande"), "montant_enveloppe", "plafond",
            (F.col("_demande").cast("double") / F.nullif(F.col("plafond"), F.lit(0.0))).alias("taux_plafond"),
        )
    )


def cofinancement_par_action(action: DataFrame, cofinancement: DataFrame) -> DataFrame:
    """Co-financing of each action and its share of the budget; actions without any have 0."""
    given = cofinancement.groupBy("id_action").agg(
        F.sum(F.col("montant").cast(MONEY)).alias("_total"), F.count("*").alias("_n")
    )
    total = F.coalesce(F.col("_total").cast("double"), F.lit(0.0))
    return action.join(given, F.col("id") == F.col("id_action"), "left").select(
        F.col("id").alias("action_id"),
        "budget_global",
        F.coalesce("_n", F.lit(0).cast("bigint")).alias("nb_cofinancements"),
        total.alias("cofinancement"),
        (total / F.nullif(F.col("budget_global"), F.lit(0.0))).alias("part_cofinancee"),
    )
