import hashlib
import random
import re

from stratalake.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, body in items:
            b = words(body)
            for k in range(max(1, len(b) - window + 1) if b else 0):
                p = b[k : k + window]
                for i in range(len(w) - len(p) + 1):
                    if w[i : i + len(p)] == p:
                        hit.update(range(i, i + len(p)))
                        ids.add(str(item))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(4)
    vocabulary = ["The", "cat", "sat", "on", "é", "mat", "7", "ÉCLAIR"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(k, text(rng.choice([2, 3, 5, 8]))) for k in range(12)] + [(3, text(6)), (98, None), (99, "..."), (5, "cat")]
    docs = [(k, text(rng.randint(0, 40))) for k in range(40)] + [(None, "the CAT"), (7, None), (8, ""), (8, ""), (100, items[0][1] * 500)]
    return docs, items


def test_like_brute_force_with_nulls_repeats_and_short_items(table, spark):
    docs, items = cases()
    got = decontaminate.report(table(docs), table(items, "item_id"), window=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, 4)


def test_blocks_of_items_give_the_same(table, spark):
    docs, items = cases()
    found = decontaminate.scan(table(docs), table(items, "item_id"), window=4, block_bytes=60)
    rows = sorted(((r.row.doc_id, r.n_words, sum(x.stop - x.start for x in r.runs), len(r["items"])) for r in found.collect()), key=repr)
    assert rows == [r[:4] for r in brute(docs, items, 4)]


def test_long_and_repeated_items_in_pieces_and_blocks(table, spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = ["The", "cat", "sat", "on", "é", "mat", "7", "ÉCLAIR", "dog", "ran"]
    words_of = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    long = words_of(300)
    items = [(1, " ".join(long))] + [(k, "the, dog: ran on é") for k in range(2, 9)] + [(2, "the, dog: ran on é")] * 50
    docs = [(k, "-".join(words_of(20) + long[9 * k : 9 * k + 12] + words_of(9))) for k in range(30)] + [(40, "The dog ran on é"), (41, None)]
    cut = decontaminate.pieces(table(items, "item_id"), "item_id", "text", 5, 16)
    assert cut.count() == 19 + 7 and max(len(r.text.split()) for r in cut.collect()) == 20
    whole = decontaminate.pieces(table([(1, " ".join(long))], "item_id"), "item_id", "text", 5).collect()
    assert [r.text.split() for r in whole] == [long]
    pieces = decontaminate.pieces
    monkeypatch.setattr(decontaminate, "pieces", lambda b, i, t, w: pieces(b, i, t, w, 16))
    found = decontaminate.scan(table(docs), table(items, "item_id"), window=5, block_bytes=500)
    rows = sorted(((r.row.doc_id, r.n_words, sum(x.stop - x.start for x in r.runs), len(r["items"])) for r in found.collect()), key=repr)
    assert rows == [r[:4] for r in brute(docs, items, 5)]


def test_original_offsets_and_clean(table, spark):
    text = "Before. The-Cat, SAT; on after"
    found = decontaminate.scan(table([(1, text)]), table([(0, "the cat sat on")], "item_id"), window=3).first()
    spans = decontaminate.original_spans(text, [(r.start, r.stop) for r in found.runs])
    assert [text[a:b] for a, b in spans] == ["The-Cat, SAT; on"]
    docs = table([(1, text), (2, "the cat"), (3, None)])
    kept = decontaminate.clean(docs, table([(0, "the cat sat on")], "item_id"), window=3)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == docs.columns


def test_empty_tables(table, spark):
    assert decontaminate.report(table([]), table([(0, "a b")], "item_id")).count() == 0
    assert decontaminate.report(table([(1, "a b")]), table([], "item_id")).first().contaminated is False
