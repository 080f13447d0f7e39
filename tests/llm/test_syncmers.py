import base64
import hashlib
import random

import numpy as np

from recurwork.llm import syncmers
from recurwork.llm.common import code_points


def places(fingerprint):
    return np.cumsum(np.frombuffer(base64.b64decode(fingerprint), syncmers.ANCHOR)["gap"].astype(int)).tolist()


def brute(text):
    h = syncmers.hashed(code_points(text))
    w = syncmers.K - syncmers.S + 1
    return [i for i in range(len(text) - syncmers.K + 1) if h[i:i + w].min() in (h[i], h[i + w - 1])]


def test_anchors_are_the_closed_syncmers_and_stand_close():
    r = random.Random(1)
    for text in ("".join(r.choice("abcd é😀") for _ in range(900)), "ab" * 100, "x" * 60, "z" * syncmers.K):
        own = places(syncmers.fingerprints(["q" * 70, text, "tail" * 30])[1])
        assert own == brute(text)
        assert max(np.diff(own), default=0) <= syncmers.K - syncmers.S


def test_runs_of_a_long_text_give_the_same(monkeypatch):
    r = random.Random(2)
    text = "".join(r.choice("abcdefgh ") for _ in range(5000))
    whole = syncmers.fingerprints([text])
    monkeypatch.setattr(syncmers, "RUN", 97)
    assert syncmers.fingerprints(["u" * 50, text, "v"])[1:2] == whole


def test_an_edit_moves_no_anchor_that_it_does_not_touch():
    r = random.Random(3)
    text = "".join(r.choice("abcdefgh ") for _ in range(3000))
    near = text[:1500] + "INSERTED" + text[1500:]
    a, b = places(syncmers.fingerprints([text])[0]), places(syncmers.fingerprints([near])[0])
    kept = [i for i in a if i + syncmers.K <= 1500] + [i + 8 for i in a if i >= 1500]
    assert set(kept) <= set(b)
    x, y = (syncmers.hashes(f) for f in syncmers.fingerprints([text, near]))
    assert 0.9 < syncmers.likeness(x, y) < 1


def test_likeness_by_position():
    assert syncmers.likeness([], []) == 1 and syncmers.likeness([1], []) == 0 and syncmers.likeness([1, 2], [3, 4]) == 0
    assert syncmers.likeness([1, 2, 3, 4], [1, 2, 9, 9]) == 0.5
    assert syncmers.likeness([1, 2, 3, 4], [4, 3, 2, 1]) == 0.25  # order counts
    assert syncmers.likeness([7, 7, 7], [7]) == 0.5


def check(df, rows):
    """Against a plain walk down the sorted rows."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[:len(text) - half] + following[:half]
        own, other, after = syncmers.fingerprints([text, changed, following])
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, other,
                     syncmers.likeness(syncmers.hashes(own), syncmers.hashes(other)), syncmers.likeness(syncmers.hashes(own), syncmers.hashes(after))))
    assert sorted((tuple(r) for r in syncmers.fingerprint_documents(df).collect()), key=repr) == sorted(want, key=repr)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(df, [(r.doc_id, r.text) for r in df.collect()])


def test_nulls_ties_repeats_long_and_empty(spark):
    rows = [(None, "a"), (None, None), (1, "x" * 60), (1, "y" * 60), (1, "x" * 60), (2, ""), (-5, "é" * 40), (9, "long text " * 60_000), (2**62, "far"), (2**62 + 1, "near far")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS key", "3 AS head")
    check(df, rows)
    check(df.where("doc_id = 9"), [rows[7]])
    check(df.where("doc_id is null"), rows[:2])
    assert syncmers.fingerprint_documents(df.limit(0)).count() == 0


def test_equal_texts_have_equal_fingerprints():
    a, b, c = syncmers.fingerprints(["same text " * 20, "same text " * 20, "same text " * 20 + "."])
    assert a == b != c
