"""The standing analyses, SQL directories and their outputs."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.operators.aggregates import ordered, totals
from claimworks.operators.labels import with_labels
from claimworks.plans import partials
from claimworks.sources.archives import CSV_TEXT
from claimworks.sources.curated import register_views
from claimworks.sources.labels import read_labels

# --- Fixed values: names of the result columns -----------------------------------------------
MONTH = {"mois_traitement": "FLX_ANN_MOI"}
REIMBURSED = {"remboursement_part_legale_eur": "FLT_REM_MNT"}
SPENT = {"depense_prefiltree_eur": "FLT_PAI_MNT"}
EXCESS = {"depassement_prefiltre_eur": "FLT_DEP_MNT"}
QUANTITY = {"quantite_prefiltree": "FLT_ACT_QTE"}
ROWS = "lignes_agregees"
NEGATIVE_ROWS = "lignes_remboursement_negatif"
SERVICE_LABEL = "libelle_prestation"
# ---------------------------------------------------------------------------------------------
NEGATIVE = "FLT_REM_MNT < 0"


@dataclass(frozen=True)
class Breakdown:
    """One analysis: codes to group by, amounts to add up, order of the result."""

    by: dict[str, str]
    sums: dict[str, str]
    order: tuple[str, ...]
    rows: str | None = None
    rows_last: bool = False
    negatives: str | None = None
    label: tuple[str, str, str] | None = None
    columns: frozenset[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "by", {**MONTH, **self.by})
        object.__setattr__(
            self, "columns", frozenset([*self.by.values(), *self.sums.values()])
        )

    def run(self, claims: DataFrame, labels: DataFrame | None = None) -> DataFrame:
        counts = {self.negatives: F.expr(NEGATIVE)} if self.negatives else None
        return self._shown(totals(claims, self.by, self.sums, self.rows, counts), labels)

    def of_states(self, states: DataFrame, labels: DataFrame | None = None) -> DataFrame:
        """The same from states of :mod:`claimworks.plans.partials`."""
        keys = tuple(self.by.values())
        groups = partials.merged(states, KEY_LISTS.index(keys), keys)
        columns = {name: F.col(c) for name, c in self.by.items()}
        if self.rows:
            columns[self.rows] = F.col(partials.ROWS)
        columns |= {name: F.col(f"{partials.SUM}{c}") for name, c in self.sums.items()}
        if self.negatives:
            columns[self.negatives] = F.col(f"{partials.COUNT}{self.negatives}")
        return self._shown(groups.select(*[c.alias(name) for name, c in columns.items()]), labels)

    def _shown(self, result: DataFrame, labels: DataFrame | None) -> DataFrame:
        if self.rows_last:
            result = result.select(*[c for c in result.columns if c != self.rows], self.rows)
        if self.label:
            variable, code, name = self.label
            result = with_labels(result, labels, variable, code, name)
        return ordered(result, *self.order)


_BY_AMOUNT = ("mois_traitement", "-remboursement_part_legale_eur")

ANALYSES: dict[str, Breakdown] = {
    "01_monthly": Breakdown(
        {}, REIMBURSED | SPENT | EXCESS | QUANTITY, ("mois_traitement",), ROWS,
        negatives=NEGATIVE_ROWS,
    ),
    "02_regions": Breakdown(
        {"code_region_residence": "BEN_RES_REG"}, REIMBURSED | SPENT,
        (*_BY_AMOUNT, "code_region_residence"), ROWS,
    ),
    "03_prestations": Breakdown(
        {"code_prestation": "PRS_NAT"}, REIMBURSED | QUANTITY, (*_BY_AMOUNT, "code_prestation"),
    ),
    "04_age": Breakdown(
        {"code_tranche_age": "AGE_BEN_SNDS"}, REIMBURSED,
        ("mois_traitement", "code_tranche_age"), ROWS, rows_last=True,
    ),
    "05_care_period": Breakdown(
        {"annee_soins": "SOI_ANN", "mois_soins": "SOI_MOI"}, REIMBURSED,
        ("mois_traitement", "annee_soins", "mois_soins"),
    ),
    "06_scope": Breakdown(
        {"top_perimetre": "TOP_PS5_TRG"}, REIMBURSED | SPENT,
        ("mois_traitement", "top_perimetre"), ROWS,
    ),
    "07_prestations_labels": Breakdown(
        {"code_prestation": "PRS_NAT"}, REIMBURSED, (*_BY_AMOUNT, "code_prestation"),
        label=("PRS_NAT", "code_prestation", SERVICE_LABEL),
    ),
}


# What the states of all analyses hold: two analyses by the same codes share a key list.
KEY_LISTS = list(dict.fromkeys(tuple(a.by.values()) for a in ANALYSES.values()))
STATE_SUMS = list(dict.fromkeys(c for a in ANALYSES.values() for c in a.sums.values()))
STATE_COUNTS = {NEGATIVE_ROWS: NEGATIVE}


def run_analyses(
    spark: SparkSession, root: str, months: list[str] | None = None
) -> dict[str, DataFrame]:
    """All standing analyses over the published months, in name order.

    Months published since the last call are read once, for all analyses together; the others' stored
    states are added up.
    """
    labels = read_labels(spark, f"{root.rstrip('/')}/references")
    return results_of(stored_partials(root).states(spark, months), labels)


def stored_partials(root: str) -> partials.Partials:
    return partials.Partials(root, KEY_LISTS, STATE_SUMS, STATE_COUNTS)


def results_of(states: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    return {name: analysis.of_states(states, labels) for name, analysis in sorted(ANALYSES.items())}


def analyses_at_once(claims: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """All standing analyses of any claims table, which is read once."""
    return results_of(partials.states_once(claims, KEY_LISTS, STATE_SUMS, STATE_COUNTS), labels)


def united(results: dict[str, DataFrame]) -> DataFrame:
    """All results as one table: ``query``, up to two codes, and every measure that some result has."""
    frames = []
    measures = {ROWS: "long", **dict.fromkeys([*REIMBURSED, *SPENT, *EXCESS, *QUANTITY], "decimal(38,6)"),
                NEGATIVE_ROWS: "long", SERVICE_LABEL: "string"}
    for name, result in results.items():
        codes = [c for c in ANALYSES[name].by if c not in MONTH]
        code = lambda i, codes=codes: (F.col(codes[i]) if i < len(codes) else F.lit(None)).cast("string")
        frames.append(result.select(
            F.lit(name).alias("query"), *MONTH, code(0).alias("code"), code(1).alias("code_2"),
            *[(F.col(c) if c in result.columns else F.lit(None)).cast(kind).alias(c) for c, kind in measures.items()],
        ))
    return reduce(DataFrame.unionByName, frames)


def run_sql_dir(spark: SparkSession, folder: str, **args) -> dict[str, DataFrame]:
    """Every ``.sql`` file of a folder in name order, as one result set each.

    The files see whatever views the session has; ``register_views`` provides the usual ones.
    ``args`` fill named parameters such as ``:month``.
    """
    files = sorted(Path(folder).glob("*.sql"))
    return {
        f.stem: spark.sql(f.read_text(encoding="utf-8"), args=args or None) for f in files
    }


def analyse(
    spark: SparkSession, root: str, sql_folder: str | None = None, months: list[str] | None = None
) -> dict[str, DataFrame]:
    """Run the standing analyses and any SQL folder, and write all results."""
    results = run_analyses(spark, root, months)
    if sql_folder:
        register_views(spark, root, months)
        own = run_sql_dir(spark, sql_folder)
        if taken := sorted(set(own) & set(results)):
            raise ValueError(f"SQL files named like standing analyses: {', '.join(taken)}")
        results |= own
    write_results(results, f"{root.rstrip('/')}/reports/analyses")
    return results


def write_results(results: dict[str, DataFrame], folder: str) -> None:
    """Each result as CSV in result order, and all of them as JSON rows by query.

    A result is kept between its writes, so the table is read once for both. Parts are in order, part
    after part. ``listing`` names the results of this run with their folders, one JSON line each, so a
    reader finds all of them and none of an earlier run.
    """
    for name, result in results.items():
        kept = result.persist()
        try:
            kept.write.mode("overwrite").options(**CSV_TEXT).csv(f"{folder}/{name}")
            exact_json(kept).write.mode("overwrite").text(f"{folder}/results/query={name}")
        finally:
            kept.unpersist()
    if results:
        session = next(iter(results.values())).sparkSession
        names = [(name, name, f"results/query={name}") for name in results]
        session.createDataFrame(names, "query string, csv string, json string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{folder}/listing")


def exact_json(df: DataFrame) -> DataFrame:
    """One JSON document per row; decimals become text, so no reader can round them."""
    columns = [
        (F.col(c).cast("string") if kind.startswith("decimal") else F.col(c)).alias(c)
        for c, kind in df.dtypes
    ]
    row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(row.alias("value"))
