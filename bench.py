"""Time the headline queries and print one JSON line.

Each query is run once to warm up and then timed, its result going to a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import registry  # noqa: E402
from temperament.session import local_session  # noqa: E402

HEADLINE = [
    "B5_preference_pairs",
    "B1_H9_accepted_questions",
    "B2_teacher_prompts",
    "B7_dialogues",
    "B8_training_table",
    "B10_choice_prompts",
    "B11_judge_prompts",
    "B12_duel_prompts",
    "B12_duel_win_rates",
    "B13_prompted_grid",
    "B17_change_report",
    "A1_mean_and_error",
    "A4_W1_trait_blocks",
    "A5_elo_ratings",
    "A5_elo_ratings_in_small_chunks",
    "A17_score_grid",
    "H5_judge_answer",
    "H8_P10_numbered_lines",
    "H16_token_length",
    "J1_same_question",
    "J5_similar_lines",
    "J5_novel_lines",
    "J8_trait_pairs",
    "P3_finished_check",
    "S1_S8_json_lines",
    "S7_partitioned_tree",
    "T4_shuffled",
    "T5_sample",
    "U1_batch_text",
    "V1_blended_vectors",
    "W3_first_per_group",
    "M1_classifier_scores",
]


def run(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    registry.load_all()
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    cold = {name: run(name, spark, folder) for name in wanted}
    warm = {name: round(run(name, spark, folder), 3) for name in wanted}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold_total": round(sum(cold.values()), 3),
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
