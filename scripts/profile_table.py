"""Turn a bench.py JSON line (run with BENCH_EVENT_LOG=1) into a Markdown table.

Usage: python scripts/profile_table.py bench.json > PROFILE.md
"""

import json
import sys


def main():
    d = json.loads(open(sys.argv[1]).read().strip().splitlines()[-1])
    prof = d.get("profile", {})
    print(f"# Measured profile (sf{d.get('sf')}, local[{d.get('cpus')}], from Spark's event log)\n")
    print("Seconds are the bench's wall time per query. Jobs, stages and tasks are counted "
          "from the event log (AQE runs each query stage as its own job). Shuffle bytes are "
          "those written by the query's stages.\n")
    print("| query | seconds | jobs | stages | tasks | longest task ms | shuffle write bytes |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, sec in d["queries"].items():
        p = prof.get(name, {})
        print(f"| {name} | {sec} | {p.get('jobs', '')} | {p.get('stages', '')} | "
              f"{p.get('tasks', '')} | {p.get('max_task_ms', '')} | {p.get('shuffle_write_bytes', '')} |")
    t = prof.get("training")
    if t:
        print(f"\nTraining block (four presets and the partition sweep on 4,096 features): "
              f"{t['jobs']} jobs, {t['tasks']} tasks, longest task {t['max_task_ms']} ms, "
              f"{t['shuffle_write_bytes']} shuffle bytes written. Tree training dominates "
              "the shuffle volume: per-node split statistics cover 4,096 features × 32 bins × classes.")


if __name__ == "__main__":
    main()
