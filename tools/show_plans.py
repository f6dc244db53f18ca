"""Write the physical plans of the main jobs to docs/PLANS.md (formatted explain).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata import fixtures  # noqa: E402
from strata.operators import clean as C  # noqa: E402
from strata.operators import serve as S  # noqa: E402
from strata.plans import sql_face  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources.files import read_silver_csv  # noqa: E402
from strata.sources.jsonl import bronze, read_lines  # noqa: E402


def _explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main(sf_dir: str) -> None:
    spark = build_session()
    raw, layers = fixtures.materialize(spark, sf_dir)
    silver = read_silver_csv(spark, layers.silver)
    gold = spark.read.parquet(layers.gold["parquet"])
    gold.createOrReplaceTempView("survey_gold")
    jobs = {
        "Bronze: raw lines -> parsed records": bronze(read_lines(spark, raw)),
        "Gold: Silver CSV -> cleaned rows": C.clean(silver),
        "A: top category per factor (DataFrame)": S.top_category(gold),
        "A: top category per factor (SQL)": spark.sql(sql_face.top_category_sql("survey_gold")),
        "B: shares within Country": S.share_within(gold, "Country", "IncreasingStress"),
        "C: shares overall": S.share_global(gold, "IncreasingStress"),
        "D: rate by Country": S.rate_by_group(gold, "Country", "MentalHealthHistory"),
        "A-E from one scan: the shared aggregate (before its checkpoint)":
            S.answer_all(gold, materialize=False)["A_rates"],
        "dedup": C.dedup(gold),
    }
    out = ["# Physical plans", "",
           f"Generated by `tools/show_plans.py` on `{sf_dir}` (local session, AQE on; the adaptive",
           "plans below are the initial ones - AQE coalesces partitions and reuses exchanges at run time).", ""]
    for title, df in jobs.items():
        out += [f"## {title}", "", "```", _explain(df).strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    text = re.sub(r"(file:)?/\S*?/strata-fixture-[0-9a-f]+", "<scratch>/strata-fixture", "\n".join(out))
    with open(path, "w") as f:
        f.write(text)
    print(path)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
