"""Naive Bayes against counts by hand, and held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import language_id
from stratalake.llm.queries import ready
from stratalake.llm.queries import table as given

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "12 34", "a", "Ab", "ÀÉ!!x", "日本 語", "a\n\nb", "...a...", "İx", "ß 9 ß", "\U0001d504\U0001d505 q", "xyz" * 50, "é" * 3]


def grams(text):
    """Characters as the operator sees them, then all n-grams."""
    seen = []
    for c in (text or "").replace("İ", "i"):
        c = c.lower()
        c = c if c.isalpha() else " "
        if c != " " or not seen or seen[-1] != " ":
            seen.append(c)
    return ["".join(seen[i : i + n]) for n in language_id.ORDERS for i in range(len(seen) - n + 1)]


def bucket(gram, bits):
    return next(f for k, (f, _) in enumerate(language_id.buckets(np.array([ord(c) for c in gram], np.uint32), np.array([0, len(gram)]), bits), 1) if k == len(gram))[0]


def test_buckets_are_those_of_all_ngrams_within_each_text():
    points, rows, lettered = language_id.characters(pa.array(ODD))
    assert lettered.tolist() == [any(c.isalpha() for c in t or "") for t in ODD]
    got = [Counter() for _ in ODD]
    for found, starts in language_id.buckets(points, rows, 16):
        for k in range(len(ODD)):
            got[k].update(found[starts[k] : starts[k + 1]].tolist())
    for text, counts in zip(ODD, got):
        if text != "İx":
            assert counts == Counter(int(bucket(g, 16)) for g in grams(text)), text


def frame(spark, rows):
    ready(spark)
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id bigint, text string, lang string, row string, k string, score string")


def test_scores_like_counts_by_hand(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["la", "el", "que", "y"] if i % 3 else ["the", "of", "and"]) for _ in range(rng.randint(1, 12))), "es" if i % 3 else "en") for i in range(60)]
    model = language_id.fit(frame(spark, rows))
    totals = {x: Counter(int(bucket(g, model.bits)) for _, t, lang in rows if lang == x for g in grams(t)) for x in ("en", "es")}
    assert model.languages == ["en", "es"] and np.allclose(np.exp(model.prior), [1 / 3, 2 / 3])
    for text in ("the la", "y", "and of que", "zzz"):
        want = []
        for x, share in (("en", 1 / 3), ("es", 2 / 3)):
            size = sum(totals[x].values()) + language_id.SMOOTHING * (1 << model.bits)
            want.append(math.log(share) + sum(math.log((totals[x][int(bucket(g, model.bits))] + language_id.SMOOTHING) / size) for g in grams(text)))
        got, _ = language_id.log_joint(pa.array([text]), model)
        assert np.allclose(got[0], want, atol=1e-4)


def test_texts_score_the_same_alone_and_between_others(spark):
    model = language_id.fit(frame(spark, [(1, "der die das", "de"), (2, "the of and", "en"), (3, "le la les", "fr")]))
    texts = [*ODD, "the die", "la", *ODD]
    alone = [language_id.log_joint(pa.array([t], pa.string()), model)[0][0] for t in texts]
    assert language_id.log_joint(pa.array(texts), model)[0].tolist() == [a.tolist() for a in alone]


def test_nulls_repeats_and_nothing_learned(spark):
    rows = [(None, "the of", "en"), (1, None, "en"), (1, None, None), (2, "", "de"), (2, "", "de"), (3, "12 !?", "fr"), (4, "und der die " * 200_000, "de"), (6, "the of and", "en")]
    assert {zlib.crc32(str(i).encode()) % 5 for i in (2, 4, 6)} != {0}
    got = language_id.report(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert [r.lang_pred for r in got if r.doc_id in (1, 2, 3)] == ["und"] * 5
    assert [r.held_out for r in got] == [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in got]
    none = language_id.report(frame(spark, [(1, "the", None), (2, None, "en")])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)] * 2
    assert language_id.report(frame(spark, [])).count() == 0


def test_many_languages_make_fewer_buckets():
    assert language_id._size(4) == 16 and language_id._size(0) == 16 and language_id._size(1_000) == 12
    with pytest.raises(ValueError, match="languages"):
        language_id._size(20_000)


def test_held_out_accuracy(spark):
    docs = given(spark, SF, "documents")
    got = language_id.report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for held_out in (True, False):
        mine = [r for r in got if r.held_out is held_out]
        assert len(mine) > 100 and np.mean([r.lang == r.lang_pred for r in mine]) > 0.97
