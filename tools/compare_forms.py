"""Times operators under other choices of their own arguments, on the same input and columns.

    python tools/compare_forms.py [sf_dir]

Overlaps with one cell for all time against the ladder of cells; the parent lookup with keys
dealt over several places against one; the lexicon as a table against the lexicon in the plan.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bindings import queries as Q  # noqa: E402
from bindings import tables as B  # noqa: E402
from lodgemart.plans.kpi import overbooking_alerts  # noqa: E402
from lodgemart.session import build_session  # noqa: E402

FORMS = {
    "overlap_alerts": {
        "ladder": Q.overlap_alerts,
        "one cell": lambda s, d: overbooking_alerts(B.room_stays(s, d), bucket_days=1_000_000),
    },
    "dq_orphan": {"one place": Q.dq_orphan, "four places": Q.dq_orphan_spread},
    "sentiment_score": {"in the plan": Q.sentiment_score, "as a table": Q.sentiment_score_joined},
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "forms", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="forms-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name, forms in FORMS.items():
        best: dict[str, float] = {}
        for _ in range(3):
            for label, form in forms.items():
                start = time.perf_counter()
                form(spark, sf_dir).write.format("noop").mode("overwrite").save()
                best[label] = min(best.get(label, 1e9), time.perf_counter() - start)
        print(name, {k: round(v, 2) for k, v in best.items()}, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
