"""Time the headline queries and print one JSON line.

Every query is materialised in full by the ``noop`` sink. The first run of each query
compiles its plan and is reported apart; the timed one is the median of three more.
"""

from __future__ import annotations

import json
import os
import time

from harness import views
from harness.queries import QUERIES
from rosterflow.session import build_session

HEADLINES = (
    "student_enrol_commands",
    "student_drop_commands",
    "student_course_counts",
    "teacher_commands",
    "coordinator_commands",
    "consolidated_commands",
    "registry_merged",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.session.timeZone": "UTC",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    first = {name: run(name) for name in HEADLINES}
    timed = {name: sorted(run(name) for _ in range(3))[1] for name in HEADLINES}
    n_courses = views.courses(spark, sf_dir).count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "first_run": first,
                "courses": n_courses,
                "staff_ms_per_course": round(1000 * timed["consolidated_commands"] / n_courses, 2),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
