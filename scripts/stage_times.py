"""Summarise a Spark event log: per job, wall time and its stages
(name, tasks, seconds).  Usage: python scripts/stage_times.py <event-log-file> [last_n_jobs]"""

import json
import sys


def main():
    path = sys.argv[1]
    last = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    stages, jobs = {}, {}
    import glob, os
    files = [path]
    while os.path.isdir(files[0]):
        files = sorted(glob.glob(os.path.join(files[0], "*")))
    lines = (ln for f in files for ln in open(f))
    for line in lines:
        d = json.loads(line)
        e = d["Event"]
        if e == "SparkListenerStageCompleted":
            si = d["Stage Info"]
            stages[si["Stage ID"]] = (si["Stage Name"][:50], si["Number of Tasks"],
                                      (si["Completion Time"] - si["Submission Time"]) / 1000)
        elif e == "SparkListenerJobStart":
            jobs[d["Job ID"]] = [d["Submission Time"], d["Stage IDs"], None]
        elif e == "SparkListenerJobEnd":
            jobs[d["Job ID"]][2] = d["Completion Time"]
    for j, (st, sids, en) in sorted(jobs.items())[-last:]:
        dur = (en - st) / 1000 if en else None
        done = [(s, *stages[s]) for s in sids if s in stages]
        print(f"job {j:4d} {dur:6.2f}s", done)


if __name__ == "__main__":
    main()
