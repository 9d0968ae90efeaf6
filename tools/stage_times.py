"""Summarise stage durations from a Spark event log folder (zstd or plain)."""
import glob
import io
import json
import sys

import zstandard


def events(folder):
    for f in sorted(glob.glob(folder + "/**/*", recursive=True)):
        base = f.rsplit("/", 1)[-1]
        if not __import__("os").path.isfile(f):
            continue
        if base.startswith(".") or "appstatus" in base or not ("events" in base or "local-" in base):
            continue
        if f.endswith(".zstd"):
            data = zstandard.ZstdDecompressor().stream_reader(open(f, "rb"))
            text = io.TextIOWrapper(data, encoding="utf-8")
        else:
            text = open(f)
        for line in text:
            line = line.strip()
            if line:
                yield json.loads(line)


def main(folder, last=80):
    stages, jobs = {}, {}
    for e in events(folder):
        ev = e["Event"]
        if ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Submission Time"], si["Completion Time"], si["Number of Tasks"], si["Stage Name"][:50])
        elif ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
    ss = sorted(stages.items(), key=lambda x: x[1][0])
    t0 = ss[0][1][0]
    for sid, (a, b, n, name) in ss[-last:]:
        print(sid, f"t={(a - t0) / 1000:7.2f} dur={(b - a) / 1000:5.2f} tasks={n} {name}")
    print("jobs:", len(jobs), "stages:", len(stages))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 80)
