"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from driver_checks import QUERIES  # noqa: E402
from maillage.session import build_session  # noqa: E402

HEADLINE = (
    "mediateurs_par_structure", "structures_par_departement", "total_subvention_v2", "personne_enrichie", "poste_par_structure",
    "postes_synthese", "postes_synthese_collapse", "coll_terr", "rollup_territory", "activites_par_territoire_periode",
    "activites_par_thematique", "beneficiaires_totaux", "consommation_enveloppe", "audit_queries", "scan_sensitive_text",
    "dq_unique", "dq_report", "resolve_merge_pairs", "merge_personne_fields", "merge_links", "dedupe_personne_ids",
    "fuzzy_name_pairs", "upsert", "join_point_in_polygon", "merge_structures", "merge_persons", "merge_structure_rows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.driver.host": "127.0.0.1", "spark.sql.catalogImplementation": "in-memory",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["agg_count"](spark, folder).collect()  # start-up is no part of any query
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
