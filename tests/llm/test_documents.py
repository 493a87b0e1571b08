"""Operators on documents against brute force, on a small table of odd rows."""

import array
import re
import zlib
from collections import Counter

import pytest

from martforge.llm import decontamination, jaccard_join, knn_quality, packing, quality_rules, sharding, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)


def test_counts_against_brute_force(odd_rows):
    texts = [r[1] for r in odd_rows] + ["a b c a b c a b c", "x\nx\n \n \nx", "a b a b a b", "q q q q"]
    for t in texts:
        assert quality_rules.text_counts(t)[:5] == brute_counts(t)


def test_rules_find_a_planted_rule():
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.random((600, 3))
    bad = (x[:, 0] > 0.7) & (x[:, 2] < 0.4)
    rules = quality_rules.learn(x, bad, ["a", "b", "c"], np.arange(600) % 3 == 0)
    got = np.zeros(600, dtype=bool)
    for r in rules:
        got |= quality_rules.covers(r, x, ["a", "b", "c"])
    assert rules and (got == bad).mean() > 0.98


def test_rules_operator(spark, clash, no_docs):
    condition = quality_rules.Condition("upper_words", True, 0.5)
    rows = quality_rules.judge(clash, [(condition,)]).collect()
    assert len(rows) == clash.count()
    for r in rows:
        counts = brute_counts(r.text)
        assert tuple(r[c] for c in quality_rules.COUNTS[:5]) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert r.kept == (not r.base_failed and r.rule is None)
    assert quality_rules.judge(no_docs, []).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.learn_rules(no_docs, labels) == []


def test_rules_on_held_out_labels(spark, small_dir):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rules = quality_rules.learn_rules(docs, labels)
    told = labels.where(knn_quality.held_out()).groupBy("doc_id").agg({"quality": "min"}).collect()
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.judge(docs, rules).collect()}
    hits = [kept[i][0] == (q == 1) for i, q in told if i in kept and not (q == 1 and kept[i][1])]
    assert sum(hits) / len(hits) > 0.95


def test_classifier_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    voters = knn_quality.train(docs, labels)
    assert len(voters.labels) <= knn_quality.VOTERS
    scores = {r.doc_id: r.score for r in knn_quality.score_quality(docs, voters).collect()}
    told = [(r.doc_id, r.quality) for r in labels.where(knn_quality.held_out()).collect() if r.doc_id in scores]
    assert sum((scores[i] >= 0.7) == (q == 1) for i, q in told) / len(told) > 0.95


def test_repeats_count_at_any_length(spark):
    """Texts of twelve words of a good document are as bad at 420 words as at 380."""
    import random

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    voters = knn_quality.train(docs, labels)
    good = docs.join(labels.where("quality = 1").where(knn_quality.held_out()), "doc_id").orderBy("doc_id").limit(60).collect()
    accepted = {}
    for n in (380, 420, 2000):
        r = random.Random(9)
        texts = []
        for row in good:
            words = r.sample(row.text.split(), 12) if len(row.text.split()) >= 12 else ["a"] * 12
            texts.append(" ".join(r.choice(words) for _ in range(n)))
        accepted[n] = float((knn_quality.vote(knn_quality.project(texts, voters), voters) >= 0.7).mean())
    print("accepted", accepted)
    assert accepted[420] <= accepted[380] + 0.1 and accepted[2000] <= accepted[380] + 0.1 and accepted[380] < 0.5


def test_repeat_share_does_not_drift():
    import random

    r = random.Random(2)
    words = [b"w%d" % i for i in range(12)]
    shares = [knn_quality.repeat_share([r.choice(words) for _ in range(n)]) for n in (100, 250, 399, 400, 401, 5000)]
    assert max(shares) - min(shares) < 0.02
    assert knn_quality.repeat_share([]) == 0 and knn_quality.repeat_share([b"a", b"b", b"a", b"a"]) == 0.5
    late = [b"u%d" % i for i in range(900)] + [b"x"] * 100
    assert knn_quality.repeat_share(late) == pytest.approx(0.098)


def test_classifier_odd_rows(spark, clash, no_docs):
    labels = spark.createDataFrame([(100 + i, i % 2, 0) for i in range(40)] + [(101, None, 0), (None, 1, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    voters = knn_quality.train(clash, labels)
    assert 0 < len(voters.labels) < 40  # the held-out fold is not learnt from
    rows = knn_quality.score_quality(clash, voters).collect()
    assert len(rows) == clash.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.score) == pytest.approx(r.score, abs=1e-5)
    none = knn_quality.train(no_docs, labels)
    assert {r.score for r in knn_quality.score_quality(clash, none).collect()} == {0.5}
    assert knn_quality.score_quality(no_docs, voters).count() == 0


def test_votes_are_exact():
    import numpy as np

    rng = np.random.default_rng(2)
    v = knn_quality.unit(rng.standard_normal((50, 8)))
    q = knn_quality.unit(rng.standard_normal((700, 8)))
    y = rng.integers(0, 2, 50).astype(float)
    voters = knn_quality.Voters(None, None, v, y, 0.5)
    got = knn_quality.vote(q, voters, 7)
    for i in range(0, 700, 37):
        cos = v @ q[i]
        near = np.argsort(-cos)[:7]
        w = np.clip(cos[near], 0, 1) ** knn_quality.SHARPNESS
        p = knn_quality.PRIOR_WEIGHT
        assert got[i] == pytest.approx((w @ y[near] + p * 0.5) / (w.sum() + p))


def test_vocabulary_equals_the_library(odd_rows):
    json_path, ranks = packing.vocabulary()
    encoder = packing.byte_bpe(json_path, ranks)
    texts = [r[1] or "" for r in odd_rows] + ["a  b", "it's  don't\n y", "  \n\n x \t y", "日本 語 x", "a\x1c b", "x\r\n  y", "' s 's", " \x85 q"]
    for t in texts:
        assert array.array("I", encoder.ids(t)).tolist() == encoder._whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(tokens=64, segments=3, loss=40)])
def test_packing_round_trip(clash, limits):
    json_path, ranks = packing.vocabulary()
    encoder = packing.byte_bpe(json_path, ranks)
    rows = packing.pack_documents(clash, json_path, ranks, limits, with_ids=True).collect()
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        documents.setdefault(r.doc_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(r.ids) // 4
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) <= limits.tokens and len(pieces) <= max(limits.segments, 1)
        assert sum(p.length - 1 for p in pieces) <= limits.loss
    texts = {}
    for r in clash.collect():
        texts.setdefault(r.doc_id, []).append(encoder.ids(r.text) + b"\0\0\0\0")
    for doc, pieces in documents.items():
        whole = texts[doc]
        if len(whole) == 1:
            pieces.sort(key=lambda r: r.start)
            assert b"".join(p.ids for p in pieces) == whole[0]
            assert {p.doc_tokens for p in pieces} == {len(whole[0]) // 4}
        assert sum(p.length for p in pieces) == sum(map(len, whole)) // 4
    assert set(documents) == set(texts)


def test_packing_leaves_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = Counter()
    for r in packing.pack_documents(docs, *packing.vocabulary()).collect():
        sizes[r.sequence_id] += r.length
    used = sum(sizes.values())
    padded = sum(n if n & (n - 1) == 0 else 1024 for n in sizes.values())
    assert used / padded > 0.995


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs, *packing.vocabulary()).count() == 0


def test_token_counts(clash, odd_rows, no_docs):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.model(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or ""))) for r in odd_rows)
    for entries in (token_counts.HOT_ENTRIES, 5, 0):
        got = Counter(tuple(r) for r in token_counts.count_tokens(clash, path, hot_entries=entries).collect())
        assert got == want
    assert token_counts.count_tokens(no_docs, path).count() == 0


def test_pre_tokens_add_up():
    import random

    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, r = token_counts.model(path), random.Random(3)
    for _ in range(3000):
        t = "".join(r.choice("ab \n▁\té日\r;)}{\"*/") for _ in range(r.randint(0, 40)))
        units = token_counts.pre_tokens(t)
        assert sum(token_counts.count_pieces(path, units)) == len(model.encode(t))


def check_shards(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(n))
    sizes = [len(by.get(s, [])) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    for got in by.values():
        assert sorted(r.slot for r in got) == list(range(len(got)))
    return by


def test_sharding(spark, clash, no_docs):
    rows = sharding.interleaved_shards(clash, 7).collect()
    assert len(rows) == clash.count()
    check_shards(rows, 7)
    assert sharding.interleaved_shards(no_docs, 4).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    skewed = docs.withColumn("source", docs.source.substr(1, 4))
    by = check_shards(sharding.interleaved_shards(skewed, 10, "source", ["doc_id"], 1).collect(), 10)
    whole = Counter(r.source for rows in by.values() for r in rows)
    for rows in by.values():
        for source, n in Counter(r.source for r in rows).items():
            assert abs(n - whole[source] / 10) <= 1.01
    again = sharding.interleaved_shards(skewed.repartition(5), 10, "source", ["doc_id"], 1).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for rows in by.values() for r in rows}


def brute_components(rows, width, percent):
    sets = {}
    for d, t in rows:
        if d is None:
            continue
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    group = {d: d for d in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                group[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (3, 40), (2, 100)])
def test_jaccard_join(spark, odd_rows, clash, width, percent):
    want = brute_components([(r[0], r[1]) for r in odd_rows], width, percent)
    rows = jaccard_join.jaccard_components(clash, width, percent).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_jaccard_join_of_near_copies(spark, no_docs, monkeypatch):
    """A large family of near copies, chains at the threshold, shared passages;
    with one hub key and a broadcast bound of nothing as well."""
    import random

    r = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    base = [r.choice(words) for _ in range(120)]
    passage = [r.choice(words) for _ in range(60)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(r.randint(0, 3)):
            t[r.randrange(len(t))] = r.choice(words)
        rows.append((i, " ".join(t)))
    chain = [r.choice(words) for _ in range(100)]
    for i in range(40):
        chain = chain[1:] + [r.choice(words)]
        rows.append((1000 + i, " ".join(chain)))
    for i in range(60):
        rows.append((2000 + i, " ".join([r.choice(words) for _ in range(r.randint(5, 300))] + passage)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 3, 90)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(docs, 3, 90).collect()}
    assert got == want
    monkeypatch.setattr(jaccard_join, "HUB_KEYS", 1)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(docs, 3, 90).collect()}
    assert got == want
    assert jaccard_join.jaccard_components(no_docs).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_jaccard_join_of_crowded_families(spark, width, percent):
    """Near copies of a text of which few pairs are linked, one family with the text
    itself and one without, copies of copies, and a text like both families."""
    import random

    r = random.Random(8)
    words = [f"v{i}" for i in range(3000)]
    rows = []
    for f, (count, edits) in enumerate([(120, 5), (120, 3), (60, 9)]):
        base = [r.choice(words) for _ in range(150 + 30 * f)]
        texts = [base] if f == 1 else []
        for _ in range(count):
            t = list(r.choice(texts) if texts and r.random() < 0.15 else base)
            for _ in range(r.randint(max(0, edits - 3), edits)):
                at = r.randrange(len(t))
                t[at : at + 1] = [r.choice(words)] * r.randint(0, 2)
            texts.append(t)
        rows += [(1000 * f + i, " ".join(t)) for i, t in enumerate(texts)]
        rows.append((9000 + f, " ".join(base[:80] + [r.choice(words) for _ in range(60)])))
    rows += [(9100, rows[3][1]), (9101, rows[150][1])]  # copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, width, percent)
    sizes = Counter(c for _, c in want.values())
    assert max(sizes.values()) < 250 and len(sizes) > 20
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(docs, width, percent).collect()}
    assert got == want


def test_family_pairs_grow_with_the_family(spark, monkeypatch):
    """Members that meet in the index of differences are few, not all pairs."""
    import random

    from martforge.llm import families

    r = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        t = list(base)
        for at in r.sample(range(300), 5):
            t[at] = f"x{i}-{at}"
        rows.append((i, " ".join(t)))
    seen = {}
    plain = families.write_shared
    monkeypatch.setattr(families, "write_shared", lambda df, label: seen.setdefault(label, plain(df, label)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(docs, 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)
    assert 0 < seen["difference-pairs"].count() < 400 * 399 / 2 / 20


def test_decontamination(spark, clash, no_docs):
    import random

    r = random.Random(6)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    say = lambda n: [r.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(r.randint(15, 90)))) for i in range(30)]
    rows, want = [], set()
    for d in range(300):
        text = say(r.randint(1, 600))
        if d % 3 == 0:
            item = items[d % 30]
            said = item[1].split()
            if d % 2:  # a paraphrase: some words left out, some put in
                said = [w.title() + "," for k, w in enumerate(said) if k % 9]
            at = r.randint(0, len(text))
            text[at:at] = said
            want.add((d, item[0]))
        rows.append((d, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items + [(50, None), (51, ""), (52, "too short")], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.find_contamination(docs, bench).collect()}
    assert not got - want
    assert len(got & want) >= 0.97 * len(want)
    assert decontamination.find_contamination(clash, bench).count() == 0
    assert decontamination.find_contamination(no_docs, bench).count() == 0
    assert decontamination.find_contamination(docs, bench.limit(0)).count() == 0


def test_common_subsequence():
    assert decontamination.common_words({1: 0b101, 2: 0b010}, 3, [1, 9, 2, 1]) == 3
    assert decontamination.common_words({1: 0b101, 2: 0b010}, 3, [2, 2, 9]) == 1


@pytest.mark.parametrize("replaced", [0.2, 0.3, 0.38])
def test_decontamination_finds_replaced_words(spark, replaced):
    """All that brute force says is 60-80 % of an item with its answer, or more."""
    import random

    r = random.Random(16)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    often = words[:40]
    say = lambda n: [r.choice(often if r.random() < 0.4 else words) for _ in range(n)]
    items = [(i, " ".join(say(r.randint(15, 60)))) for i in range(200)]
    rows, want = [], set()
    for d, item in items:
        said = item.split()
        n = len(said)
        for k in r.sample(range(n - decontamination.ANSWER_WORDS), min(int(replaced * n), n - decontamination.ANSWER_WORDS)):
            said[k] = r.choice(words)
        places = {}
        for i, w in enumerate(item.split()):
            places[w] = places.get(w, 0) | 1 << i
        assert decontamination.common_words(places, n, said) >= 0.6 * n
        text = say(r.randint(50, 400))
        at = r.randint(0, len(text))
        rows.append((d, " ".join(text[:at] + said + text[at:])))
        want.add((d, d))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.find_contamination(docs, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want
    assert all(-1 <= x.cosine <= 1.001 and x.lcs_words >= 0.6 * x.item_words for x in got)


def test_shared_words_in_small_parts(monkeypatch):
    """The stretches that share words do not depend on the parts looked at."""
    import random

    import numpy as np
    import pyarrow as pa

    r = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    items = [decontamination.make_item(i, " ".join(r.choices(words, k=r.randint(8, 70)))) for i in range(30)]
    texts = pa.array([" ".join(r.choices(words, k=r.randint(0, 900))) for _ in range(12)] + [None, " ".join(items[3].words)])
    space = np.random.default_rng(1).standard_normal((decontamination.BUCKETS + 1, 8)).astype(np.float32)
    finder = decontamination.Search(items, space, np.ones(decontamination.BUCKETS, np.float32))
    whole = set(finder.sharing(*decontamination.batch_terms(texts)))
    assert (13, 0, 3, None) in whole
    monkeypatch.setattr(decontamination, "SHARED_WORDS", 1)
    assert set(finder.sharing(*decontamination.batch_terms(texts))) == whole


def test_products_are_shuffled_by_filled_rows():
    """A task that has few terms sends few rows, whatever the number of tasks."""
    import numpy as np

    total = np.zeros((decontamination.BUCKETS, 5), np.float32)
    total[[3, 700, decontamination.BUCKETS - 1]] = np.arange(15, dtype=np.float32).reshape(3, 5) + 1
    again, sent = np.zeros_like(total), 0
    for i, (places, part) in enumerate(decontamination.filled_rows(total, 512)):
        again[i * 512 + places] += part
        sent += part.nbytes
    assert (again == total).all() and sent == 3 * 5 * 4


def test_the_driver_holds_no_copies_of_the_range(monkeypatch):
    """The space is that of a whole QR, also of few passages, and beside the matrix and
    its product the driver holds less than another copy of it."""
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(1)
    width = decontamination.RANK + decontamination.EXTRA
    idf = r.random(decontamination.BUCKETS).astype(np.float32)
    for passages in (40, 400):
        a = np.zeros((passages, decontamination.BUCKETS), np.float32)
        for row in a:
            row[r.integers(0, 2000, 30)] = r.random(30)

        def products(spark, sample, idf, q, gram):
            y = a @ q
            total = y.T @ y if gram else a.T @ y
            size = len(total) if gram else decontamination.SUM_ROWS
            return [total[i : i + size] for i in range(0, len(total), size)]

        monkeypatch.setattr(decontamination, "_products", products)
        got = decontamination.latent_space(None, None, idf)
        q = np.random.default_rng(3).standard_normal((decontamination.BUCKETS, width)).astype(np.float32)
        for _ in range(decontamination.POWER):
            q = np.linalg.qr(a.T @ (a @ q))[0]
        values, vectors = np.linalg.eigh(((a @ q).T @ (a @ q)).astype(np.float64))
        top = np.argsort(values)[::-1][: decontamination.RANK]
        usable = values[top] > 1e-6 * values[top][0]
        want = (q @ (vectors[:, top] * np.where(usable, 1 / np.sqrt(np.maximum(values[top], 1e-9)), 0))) * idf[:, None]
        # The axes may turn over; the cosines of windows are those of the whole QR.
        some = r.integers(0, 2000, 60)
        left, right = got[some] @ got[some].T, want[some] @ want[some].T
        assert np.abs(left - right).max() < 2e-3 * np.abs(right).max() and not got[-1].any()

    y = np.ones((decontamination.BUCKETS, width), np.float32) + r.random((decontamination.BUCKETS, width), np.float32)
    chunks = [y[i : i + 512] for i in range(0, len(y), 512)]
    monkeypatch.setattr(decontamination, "_products", lambda spark, sample, idf, q, gram: [np.eye(width, dtype=np.float32)] if gram else chunks)
    tracemalloc.start()
    decontamination.latent_space(None, None, idf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.5 * y.nbytes


def test_candidates_without_enough_words_are_not_compared():
    """Nothing that a subsequence could reach is left out; a word that an item has once
    counts once, and a candidate found in two ways is given once."""
    import random

    import numpy as np
    import pyarrow as pa

    r = random.Random(8)
    words = [f"w{i}" for i in range(40)]
    items = [decontamination.make_item(i, " ".join(r.choices(words, k=r.randint(8, 40)))) for i in range(20)]
    space = np.random.default_rng(2).standard_normal((decontamination.BUCKETS + 1, 8)).astype(np.float32)
    finder = decontamination.Search(items, space, np.ones(decontamination.BUCKETS, np.float32))
    texts = pa.array([" ".join(r.choices(words, k=r.choice([0, 1, 50, 300]))) for _ in range(30)] + [f"{items[0].words[0]} " * 200, None])
    terms, starts = decontamination.batch_terms(texts)
    asked = list(finder.candidates(terms, starts)) + list(finder.sharing(terms, starts))
    doc, at, k = (np.array(x) for x in list(zip(*asked))[:3])
    may = finder.may_hold(terms, starts, doc, at, k)
    for d, w, i, ok in zip(doc.tolist(), at.tolist(), k.tolist(), may.tolist()):
        n = len(items[i].words)
        low = int(starts[d])
        region = terms[low + max(0, w - n) : min(low + w + decontamination.PASSAGE + n, int(starts[d + 1]))].tolist()
        if decontamination.common_words(finder.masks[i], n, region) >= decontamination.MIN_LCS_WITH_ANSWER * n:
            assert ok
        if d == 30:
            assert not ok  # one word, 200 times
    near = [x[:3] for x in finder.near_enough(terms, starts)]
    assert len(near) == len(set(near)) and set(near) == {x[:3] for x, ok in zip(asked, may) if ok}
