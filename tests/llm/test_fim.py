import hashlib
import random
import re

import numpy as np

from recurwork.llm import fim

DOCS = "doc_id long, text string"


def plain_version(doc_id, text, rules=fim.Rules()):
    text = text or ""
    h = hashlib.sha256(f"{rules.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in rules.sentinels) or h[2] % 100 >= rules.percent:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < rules.percent_spm:
        return n, "spm", len(p), len(m), f"{rules.suffix}{s}{rules.prefix}{p}{rules.middle}{m}"
    return n, "psm", len(p), len(m), f"{rules.prefix}{p}{rules.suffix}{s}{rules.middle}{m}"


def test_marks_of_words_are_exact():
    r = random.Random(1)
    data = bytes(r.choice(b"\x09\x0a\x0b\x8a\x00\xff\xc3\x80") for _ in range(4001))
    words = fim.words_of(data)
    for marks, at in ((fim.equal_bytes(words, 10), [i for i, b in enumerate(data) if b == 10]),
                      (fim.code_point_starts(words), [i for i, b in enumerate(data) if b & 0xC0 != 0x80])):
        m = fim.Marks(marks)
        assert m.select(np.arange(1, len(at) + 1)).tolist() == at
        assert m.rank(np.arange(len(data) + 1)).tolist() == [sum(x < i for x in at) for i in range(len(data) + 1)]


def random_text(r):
    return "".join(r.choice(["\n", "\n", "a", "é", "漢", "😀", "\r", "<P", "<", " "]) for _ in range(r.randint(0, 60)))


def test_same_as_a_plain_version():
    r = random.Random(2)
    texts = [None, "", "\n", "\n\n\n", "no line end", "one\n", "<M>", "x" * 100_000 + "\n" + "é" * 100_000] + [random_text(r) for _ in range(800)]
    ids = [None if i % 50 == 0 else r.randint(-5, 10**12) for i in range(len(texts))]
    for rules in (fim.Rules(), fim.Rules(seed=3, percent=40, percent_spm=90, prefix="[pre]", suffix="[suf]", middle="(.*)")):
        got = list(zip(*fim.transform(ids, texts, rules), strict=True))
        assert got == [plain_version(i, t, rules) for i, t in zip(ids, texts, strict=True)]
        assert len({g[1] for g in got}) == 3


def test_frames_restore_their_texts(spark):
    r = random.Random(3)
    rows = [(i, random_text(r)) for i in range(200)] + [(None, None), (None, "a\nb"), (7, "same\nrow\n"), (7, "same\nrow\n"), (8, ""), (9, "<<S\n<P\n>")]
    for rules in (fim.Rules(), fim.Rules(prefix="[p]", suffix="$s^", middle="(m|")):
        docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS output", "1 AS n", "'y' AS form")
        out = fim.fill_in_middle(docs, rules)
        got = out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output",
                         fim.restored(out.output, out.form, rules).alias("text")).collect()
        want = [(i, *plain_version(i, t, rules), t or "") for i, t in rows]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert fim.digests(fim.fill_in_middle(spark.createDataFrame([], DOCS))).collect() == []


def test_query_equals_its_sql(spark, same_as_sql):
    same_as_sql(spark, "op11_fim")
