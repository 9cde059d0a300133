"""Importance resampling against a plain computation over all features."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import pytest

from lexistat.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(docs, target):
    """``docs`` of (doc_id, text): rows as the contract states them, in the order of their scores."""
    raw = Counter(bucket(f) for _, text in docs for f in features(text)[1])
    wanted = Counter(bucket(f) for text in target for f in features(text)[1])
    S, T = sum(raw.values()), sum(wanted.values())

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (S + 10000) / ((raw[b] + 1) * (T + 10000))))

    rows = []
    for doc, text in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found)
        name = "42:" + ("" if doc is None else str(doc))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 5 * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def check(docs, target):
    got = importance.resample(docs, target).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == brute(rows, [r["text"] for r in target.collect()])


@pytest.fixture
def target(spark):
    texts = ["Alpha beta gamma\ndelta, alpha", None, "", "été 東京 x1", "alpha beta"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id int, text string")


def test_random_texts(documents, target):
    chance = random.Random(5)
    some = ["alpha", "Beta", "gamma", "delta", "été", "x1", "--", "東京", " ", "_"]
    rows = []
    for i in range(240):
        lines = [" ".join(chance.choices(some, k=chance.randrange(8))) for _ in range(chance.randrange(1, 9))]
        rows.append((i, chance.choice(["\n", "\n\n", "\r\n"]).join(lines)))
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # copies
    rows += [(5, "alpha " * 30), (5, "alpha " * 30), (None, "beta\n" * 25)]
    check(documents(rows), target)


def test_awkward_rows(awkward, documents, target, spark):
    check(awkward, target)
    assert importance.resample(documents([]), target).collect() == []
    none = spark.createDataFrame([], "item_id int, text string")
    check(awkward, none)


def test_small_batches(documents, target, monkeypatch):
    monkeypatch.setattr(importance, "_BATCH_BYTES", 16)
    lines = [b"alpha beta gamma", b"delta", b"--", b"", b"alpha"]
    number, at = importance._features(lines, 10_000)
    wanted = [(bucket(f), i) for i, line in enumerate(lines) for f in features(line.decode())[1]]
    assert sorted(zip(number.tolist(), at.tolist(), strict=True)) == sorted(wanted)
    check(documents([(i, f"alpha beta {i}\ngamma") for i in range(20)]), target)


def test_runs_over_line_ends():
    lines = [[b"a"], [b"b"], [b"c", b"d", b"e"], [b"f"]]
    runs = ["a b", "b c", "a b c", "b c d", "e f", "d e f"]
    assert sorted(importance._crossing(lines, 10_000)) == sorted(bucket(r) for r in runs)


def test_sf_table_against_the_plain_way(spark):
    folder = "/root/testdata/sf0.001"
    check(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
