"""Summarise a Spark event log (rolling, possibly zstd-compressed): jobs, stages, tasks.

Usage: python tools/evlog.py <event-log-dir> [last_n_jobs]
"""

from __future__ import annotations

import glob
import io
import json
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv):
    root = argv[1]
    last = int(argv[2]) if len(argv) > 2 else 20
    files = sorted(glob.glob(f"{root}/**/events_*", recursive=True)) or sorted(glob.glob(f"{root}/*"))
    jobs, stages, tasks = {}, {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], None, [s["Stage ID"] for s in e["Stage Infos"]]]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (
                    si["Stage Name"][:40],
                    si["Number of Tasks"],
                    si.get("Submission Time", 0),
                    si.get("Completion Time", 0),
                )
            elif ev == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    js = sorted(jobs.items())[-last:]
    if not js:
        return 0
    t0 = js[0][1][0]
    print(f"{len(jobs)} jobs in total; last {len(js)}:")
    for jid, (start, end, sids) in js:
        print(f"job {jid:4d} +{start - t0:6d}ms dur {end - start if end else -1:5d}ms")
        for sid in sids:
            if sid in stages:
                name, n, s, c = stages[sid]
                print(f"   stage {sid:4d} {name:40s} tasks {n:3d} dur {c - s:5d}ms max task {max(tasks.get(sid, [0])):5d}ms")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
