"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is
built and run in full into the no-op sink twice; the second run is reported, so
that code generation of the young JVM is left out ("first" holds the sum of the
first runs). Building the plan, with its counts, is part of the time.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from formline.plans import star  # noqa: E402
from formline.session import build_session  # noqa: E402

HEADLINE = """
form_prev_last3_last7 form_inclusive_vs_upcoming form_matchup team_form_median_warmup own_opponent_form
running_sum_per_game ratio_per_opportunity season_hit_rate hit_rate_30d rank_direction_aware rank_by_games_played
usage_rank_in_game latest_flag ordinal_percentile situation_pivot situation_all_plus_each schedule_expand
schedule_outer_join roster_fill_next_only last_known_fill anti_join_append upsert_keyed priority_merge snapshot_diff
ordered_dedupe event_counts_for_against possession_pct rebounds events_in_interval totals_in_intervals
first_within_tolerance nearest_date_match two_tier_lookup either_order_pair current_streak hit_rates_last_n
game_analysis recent_trends historical_games pick_grading layer_profile dup_groups vector_topk regression_metrics
stream_dedupe_append predictions_view season_rank_map player_game_stats team_game_stats bi_summary player_form_fanout
ml_score ml_feature_select
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "formline-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_custkey").count().write.format("noop").mode("overwrite").save()

    def timed(name: str) -> float:
        start = time.perf_counter()
        star.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    first, times = {}, {}
    for name in names:
        first[name] = timed(name)
        times[name] = timed(name)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
        "first": round(sum(first.values()), 3),
        "cold": first,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
