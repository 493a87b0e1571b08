"""Source mixture, prefix trie and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from martforge.llm import periodic_runs, prefix_trie, source_mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- source mixture -----------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), laps=3):
    """Targets by sharing, stopping and sharing again, until none is above its stop."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    stopped = set()
    while True:
        left = sum(sizes.values()) - sum(laps * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        total = sum(weight[s] for s in free)
        target = {s: laps * sizes[s] if s in stopped else left * weight[s] / total for s in order}
        above = {s for s in free if target[s] > laps * sizes[s] + 1e-9}
        if not above:
            return target
        stopped |= above


def brute_quotas(target, house):
    """Blocks one by one to the highest quotient."""
    order = sorted(target, key=lambda s: (s is None, s or ""))
    seats = dict.fromkeys(order, 0)
    for _ in range(house):
        best = max(order, key=lambda s: (target[s] / (2 * seats[s] + 1), -order.index(s)))
        seats[best] += 1
    return seats


def test_mix_against_brute_force(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):  # one source with a third of all, a small one with a large weight, a null one
        source = "hot" if i % 3 == 0 else "a-small" if i % 100 == 1 else None if i % 7 == 0 else f"s{i % 4}"
        text = None if i % 31 == 0 else " ".join(f"w{r.randrange(50)}" for _ in range(r.randrange(60)))
        rows.append((i if i % 50 else None, source, text))
    rows += [(9, "s1", "same text here")] * 3 + [(1000, "hot", "x " * 5000)] + [(2000, "silent", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    mixed, quotas = source_mix.mix_sources(docs, shards=5, block_words=16, seed=4)
    got = mixed.collect()
    assert Counter((g.doc_id, g.source, g.size) for g in got) == Counter(
        (d, s, len(WORD.findall(t or ""))) for d, s, t in rows
    )
    sizes = defaultdict(int)
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets(sizes)
    total = sum(sizes.values()) // 16
    by_source = {q.source: q for q in quotas.collect()}
    assert any(abs(target[s] - 3 * sizes[s]) < 1e-9 and sizes[s] for s in target), "a source should stop"
    for shard in range(5):
        want = brute_quotas({s: t for s, t in target.items() if t}, total * (shard + 1) // 5)
        assert {s: by_source[s].quotas[shard] for s in want} == want
    taken, of_shard = defaultdict(int), Counter()
    for g in got:
        assert g.source_size == sizes[g.source] and abs(g.target - target[g.source]) < 1e-6
        laps = defaultdict(set)
        for p in g.pieces:
            words = set(range(p.start, p.start + p.length))
            assert p.length > 0 and words <= set(range(g.size)) and not words & laps[p.lap]
            laps[p.lap] |= words
            of_shard[g.source, p.shard] += p.length
        assert set(laps) <= {0, 1, 2}
        taken[g.source] += sum(p.length for p in g.pieces)
    for s, q in by_source.items():
        blocks = min(q.quotas[-1], 3 * sizes[s] // 16)
        assert taken[s] == 16 * blocks and abs(taken[s] - target[s]) <= 32
        if blocks == q.quotas[-1]:
            for shard, until in enumerate(q.quotas):
                before = q.quotas[shard - 1] if shard else 0
                assert of_shard[s, shard] == 16 * (until - before)
    again, _ = source_mix.mix_sources(docs.repartition(7), shards=5, block_words=16, seed=4)
    key = lambda x: (str(x.doc_id), str(x.source), x.size, str(x.pieces))
    assert sorted(map(key, again.collect())) == sorted(map(key, got))


def test_mix_of_odd_tables(spark, clash, no_docs):
    mixed, _ = source_mix.mix_sources(clash)
    assert mixed.count() == clash.count()
    assert mixed.where("target > 3 * source_size").isEmpty()
    mixed, quotas = source_mix.mix_sources(no_docs)
    assert mixed.count() == 0 and quotas.count() == 0
    silent = clash.limit(4).withColumn("text", F.lit(None).cast("string"))
    mixed, _ = source_mix.mix_sources(silent)
    assert [(r.size, r.target, r.pieces) for r in mixed.collect()] == [(0, 0.0, [])] * 4


# -- prefix trie --------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in turns:
        turns[c] = [(r, t) for _, _, r, t in sorted(turns[c])]
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + turns[c][h:]
    nodes = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    out = {}
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    for path, of in sorted(nodes.items(), key=lambda x: -len(x[0])):
        leaves = sum(out[x][5] for x in children[path]) or 1
        saved = (len(of) - 1) * (len(WORD.findall(path[-1][1])) if path else 0) + sum(out[x][6] for x in children[path])
        ends = ",".join(map(str, sorted(c for c in of if len(rebuilt[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out[path] = (min(of), len(path), parent, len(of), len(children[path]), leaves, saved, sha(ends))
    return sorted(out.values(), key=str)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
TURNS = "conv_id long, turn long, role string, text string"


def trie_of(df):
    conv = F.col("conv_id")
    found = prefix_trie.prefix_trie(df, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    return sorted((tuple(r[c] for c in NODE) for r in found.collect()), key=str)


def conversations(seed):
    r = random.Random(seed)
    rows = []
    for c in range(130):
        if c in (20, 47):
            continue  # a base that is absent, and one that is not
        for turn in range(r.choice((1, 2, 3, 5))):
            text = r.choice(("hi there", "hi there", "a b\tc", "", "long " * r.randint(1, 4)))
            rows.append((c, turn, r.choice(("user", "user", None)), text))
    copy = [("user" if k % 2 else "assistant", f"turn {k}") for k in range(60)]
    for c in (200, 221, 222, 223, 224, 240):  # equal long conversations
        rows += [(c, k, *t) for k, t in enumerate(copy)]
    rows += [(300, None, "user", "first"), (300, 0, "user", None), (None, 0, "user", "no conversation")]
    rows += [(301, 1, "user", "twice"), (301, 1, "user", "twice")]
    r.shuffle(rows)
    return rows


def test_trie_against_brute_force(spark):
    for seed in (1, 2):
        rows = conversations(seed)
        df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("taken") for c in ("depth", "p1", "words", "one", "_part")})
        assert trie_of(df.repartition(5)) == brute_trie(rows)


def test_trie_of_a_conversation_over_many_tasks(spark):
    rows = [(7, k, "user", f"t{k % 5}") for k in range(3000)] + [(c, 0, "user", "t0") for c in range(40)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trie_of(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_of_odd_tables(spark):
    assert trie_of(spark.createDataFrame([], TURNS)) == []
    turnless = [(21, 0, "user", "dropped")]  # its head is three turns of a base that is absent
    h = zlib.crc32(b"21") % 4
    got = trie_of(spark.createDataFrame(turnless, TURNS))
    assert got == brute_trie(turnless) and (len(got) == 1) == (h > 0)


def test_equal_names_are_noticed(spark, monkeypatch):
    """Digests that clash for the first seed are found by the stored turns, and another seed is used."""
    real = prefix_trie.turn_name
    assert real(0, b"a", b"b") != real(1, b"a", b"b") and real(0, b"ab", b"") != real(0, b"a", b"b")
    rows = [(0, 0, "user", "x"), (1, 0, "user", "y")]
    df = spark.createDataFrame(rows, TURNS)
    assert prefix_trie.ambiguous_turns(df, 0).isEmpty()
    monkeypatch.setattr(prefix_trie, "turn_name", lambda seed, r, t: real(seed, r, t if seed else b""))
    assert prefix_trie.ambiguous_turns(df, 0).count() == 1
    assert trie_of(df) == brute_trie(rows)


def test_products_combine():
    r = random.Random(0)
    maps = [prefix_trie.turn_name(0, b"r", str(r.random()).encode()) for _ in range(6)]
    left = maps[0]
    for m in maps[1:]:
        left = prefix_trie.product(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = prefix_trie.product(m, right)
    assert left == right
    head = prefix_trie.product(maps[0], maps[1])
    rest = prefix_trie.product(prefix_trie.inverse(head), left)
    assert prefix_trie.product(head, rest) == left
    assert prefix_trie.product(maps[0], maps[1]) != prefix_trie.product(maps[1], maps[0])


# -- periodic runs ------------------------------------------------------------


def brute_runs(words, min_length=12):
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def test_runs_against_brute_force():
    r = random.Random(5)
    for _ in range(300):
        texts = []
        for _ in range(r.randint(1, 4)):
            n = r.randrange(70)
            words = [b"%d" % r.randrange(r.randint(1, 4)) for _ in range(n)]
            if n and r.random() < 0.5:
                p = r.randint(1, n)
                words = [words[i % p] for i in range(n)]
                words[r.randrange(n)] = b"z"
            texts.append(words)
        for least in (2, 12):
            for words, (rows, kept) in zip(texts, periodic_runs.block_runs(texts, least)):
                want = sorted(brute_runs(words, least), key=lambda x: (x[0], x[2]))
                assert [(x["start"], x["length"], x["period"]) for x in rows] == want
                gone = {i for s, n, q in want for i in range(s + q, s + n)}
                assert kept == [w for i, w in enumerate(words) if i not in gone]


def test_runs_of_long_and_odd_texts(spark, odd_rows, clash, no_docs):
    found = {}
    for row in periodic_runs.find_runs(clash.withColumn("runs", F.lit("taken"))).collect():
        words = [w.encode() for w in WORD.findall(row.text or "")]
        if len(words) < 400:
            assert [tuple(x) for x in row.runs] == sorted(brute_runs(words), key=lambda x: (x[0], x[2]))
        found[row.doc_id] = row
        assert row.score == "taken"
    assert len(found) == len({r[0] for r in odd_rows})
    assert found[0].runs == [] and found[0].collapsed == ""
    assert periodic_runs.find_runs(no_docs).count() == 0
    long = spark.createDataFrame([(1, "same " * 150_000), (2, "a b c " * 50_000)], "doc_id long, text string")
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find_runs(long).collect()}
    assert got == {1: ([(0, 150_000, 1)], "same"), 2: ([(0, 150_000, 3)], "a b c")}


def test_runs_query_against_brute_force(spark, small_dir):
    got = {r.doc_id: r for r in periodic_runs.op13_periodic_runs(spark, small_dir).collect()}
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for d in docs:
        words = WORD.findall(d.text or "")
        n, h = len(words), zlib.crc32(str(d.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 1500:
            continue  # too slow by brute force
        runs = sorted(brute_runs(words), key=lambda x: (x[0], x[2]))
        row = got[d.doc_id]
        assert row.n_runs == len(runs)
        assert row.runs_sha256 == sha("".join(f"{s},{x},{q}\n" for s, x, q in runs))
        gone = {i for s, x, q in runs for i in range(s + q, s + x)}
        assert row.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in gone))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row.start, row.length, row.period, row.exponent_milli) == want
    assert planted > 5
