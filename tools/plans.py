"""Write PLANS.md: physical plans of the questions over a written star, and of
the silver view and fact build over the supplied tables.

Usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue().strip()
    text = re.sub(r"#\d+L?", "", text)                      # expression ids
    text = re.sub(r"file:[^\]]*/tripmart/", "<shared>/", text)  # scratch paths
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"-[0-9a-f]{12}/", "/", text)                # unique folder suffixes
    return text


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from tripmart.config import TESTDATA
    from tripmart.operators import checks as K
    from tripmart.operators import gold as G
    from tripmart.plans.catalog import layers
    from tripmart.plans.questions import QUESTIONS
    from tripmart.session import local_session, new_table_path

    spark = local_session(8, 16)
    ly = layers(spark, sf_dir, TESTDATA)
    star = G.write_star(spark, ly.star, new_table_path(spark, "plans_star"), rebalance=True)
    star.zones()
    out = ["# PLANS", "",
           "Physical plans (`explain()`, before AQE re-optimization) produced by "
           "`python tools/plans.py`. Expression ids and scratch paths are elided. The questions "
           "run over a written star (fact partitioned by `pickup_month`); silver and the fact "
           "build run over the supplied tables through the adapter.", ""]
    sections = [("silver view (adapter -> bronze -> silver)", ly.silver),
                ("fact build (map-only)", ly.star.fct)]
    sections += [(name, fn(star)) for name, fn in QUESTIONS.items()]
    models = {"silver_trips": ly.silver, "zone_lookup": ly.bronze.zones,
              "dim_service_type": star.dim_service_type,
              "dim_payment_type": star.dim_payment_type, "dim_zone": star.dim_zone,
              "dim_date": star.dim_date, "fct_trips": star.fct}
    sections.append(("quality report (declared suite)",
                     K.run_checks(spark, K.REFERENCE_SUITE, models)))
    for title, df in sections:
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    (ROOT / "PLANS.md").write_text("\n".join(out))
    print(f"wrote {ROOT / 'PLANS.md'}")


if __name__ == "__main__":
    main(sys.argv)
