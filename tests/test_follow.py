import json
import os

import pytest

from moodlake.jobs import ingest as job
from moodlake.streaming import ingest
from moodlake.streaming.enrich import run

HEADER = "id,timestamp,tweet_text\n"


def put(folder, name, text):
    os.makedirs(folder + "/in", exist_ok=True)
    with open(f"{folder}/in/{name}", "w") as f:
        f.write(text)


def taken(spark, folder):
    run(ingest.follow(spark, folder + "/in", folder + "/out", folder + "/c", trigger=None, max_files=1))
    posts = sorted(json.loads(r.value)["id"] for r in spark.read.text(folder + "/out/messages/*").collect())
    rejects = sorted((r.id, r.reject_reason) for r in spark.read.schema("id string, reject_reason string").json(folder + "/out/rejects/*").collect())
    counts = sorted(tuple(r) for r in ingest.progress(spark, folder + "/out").collect())
    return posts, rejects, counts


def test_messages_rejects_and_counts_of_every_batch(spark, folder):
    put(folder, "a.csv", HEADER + '1,2024-01-02 03:04:05,"two\nlines"\n2,x,  \n')
    put(folder, "b.csv", HEADER + "3,2024-01-02 03:04:05,text\n")
    posts, rejects, counts = taken(spark, folder)
    assert (posts, rejects) == (["1", "3"], [("2", "empty_text")])
    assert sorted(c[1:] for c in counts) == [(1, 1, 0), (2, 1, 1)] and [c[0] for c in counts] == [0, 1]
    # A restart takes in what is new only.
    put(folder, "c.csv", HEADER + "4,x,\n5,x,y\n")
    posts, rejects, counts = taken(spark, folder)
    assert (posts, rejects) == (["1", "3", "5"], [("2", "empty_text"), ("4", "empty_text")])
    assert counts[2] == (2, 2, 1, 1)


def test_a_repeated_batch_replaces_itself(spark, folder):
    put(folder, "a.csv", HEADER + "1,x,a\n2,x,\n")
    first = taken(spark, folder)
    os.remove(folder + "/c/commits/0")
    for name in os.listdir(folder + "/c/commits"):
        if name.startswith(".0"):
            os.remove(f"{folder}/c/commits/{name}")
    assert taken(spark, folder) == first


def test_messages_go_to_a_broker(spark, folder):
    sent = []
    put(folder, "a.csv", HEADER + "1,x,a\n2,x,\n")
    run(ingest.follow(spark, folder + "/in", folder + "/out", folder + "/c", trigger=None, send=lambda df: sent.extend(df.collect())))
    assert [json.loads(r.value)["id"] for r in sent] == ["1"] and not os.path.exists(folder + "/out/messages")


def test_job(spark, folder, capsys):
    put(folder, "a.csv", HEADER + "1,x,a\n2,x,\n")
    want = {"read": 2, "accepted": 1, "rejected": 1}
    assert job.main([folder + "/in", "--follow", "--once", "--out", folder + "/out", "--checkpoint", folder + "/c"]) == want
    # The same as one batch, whose rejects come from the same pass over the files.
    assert job.main([folder + "/in", "--out", folder + "/messages", "--rejects", folder + "/rejects"]) == want
    assert [json.loads(line)["id"] for line in (r.value for r in spark.read.text(folder + "/rejects").collect())] == ["2"]
    for flags in (["--follow", "--out", "o"], ["--follow", "--out", "o", "--checkpoint", "c", "--rejects", "r"]):
        with pytest.raises(SystemExit):
            job.main([folder + "/in", *flags])
    capsys.readouterr()
