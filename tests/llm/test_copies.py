"""SimHash, winnowing, suffixes and the pipeline against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from gevel.llm import queries, simhash, suffix, winnow
from gevel.llm.components import components
from tests.llm import messy


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_simhash_query(spark, sf):
    docs = {r["doc_id"]: fingerprint(r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = groups([(a, b) for a in docs for b in docs if a < b and (docs[a] ^ docs[b]).bit_count() <= 4], docs)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op9_simhash(spark, sf).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in docs.items()}


def test_simhash_odd_rows(spark, tmp_path):
    """Odd rows, and near copies that only a row without doc_id connects; such a row names no component."""
    base = "one two three four five six seven eight nine ten " * 6
    lone = [(None, "only " + base), (900, base), (901, base.replace("six", "sixx", 1)), (None, base + "tail"), (None, "nobody shares this text at all"), (None, "nobody shares this text at all")]
    messy.frame(spark).select("doc_id", "text", "lang").unionByName(spark.createDataFrame(lone, "doc_id long, text string"), allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r[0], fingerprint(r[1])) for r in messy.rows()] + [(d, fingerprint(t)) for d, t in lone]
    n = range(len(rows))
    group = groups([(a, b) for a in n for b in n if a < b and (rows[a][1] ^ rows[b][1]).bit_count() <= 4], n)
    least = {}
    for k in n:
        if rows[k][0] is not None:
            least[group[k]] = min(rows[k][0], least.get(group[k], rows[k][0]))
    want = Counter((d, f"{f:016x}", least.get(group[k])) for k, (d, f) in enumerate(rows))
    assert Counter(map(tuple, queries.op9_simhash(spark, str(tmp_path)).collect())) == want
    assert simhash.near_groups(simhash.fingerprints(messy.empty(spark))).count() == 0


@pytest.mark.parametrize("tau, block", [(0, 256), (4, 256), (4, 7), (7, 5)])
def test_links_connect_all_that_are_near(spark, tau, block):
    rng = np.random.default_rng(tau + block)
    centre = rng.integers(-(2**63), 2**63, 12)
    prints = list({int(c) ^ (1 << int(a)) ^ (1 << int(b)) if (a, b) != (63, 63) else int(c) for c in centre for a, b in rng.integers(0, 62, (25, 2))})
    found = simhash.links(spark.createDataFrame(list(enumerate(prints)), "node long, fingerprint long"), tau, block=block).collect()
    apart = lambda x, y: ((x ^ y) & (2**64 - 1)).bit_count()
    n = range(len(prints))
    want = groups([(a, b) for a in n for b in n if a < b and apart(prints[a], prints[b]) <= tau], n)
    assert groups([(r["a"], r["b"]) for r in found], n) == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def windows_of(items):
    found = defaultdict(set)
    for key, text in items:
        words = WORDS.findall(low(text))
        n = min(10, len(words))
        for i in range(len(words) - n + 1) if n else ():
            found[tuple(words[i : i + n])].add(key)
    return found


def hit(text, found):
    words, covered, items = WORDS.findall(low(text)), set(), set()
    for n in {len(w) for w in found}:
        for i in range(len(words) - n + 1):
            if owners := found.get(tuple(words[i : i + n])):
                covered |= set(range(i, i + n))
                items |= owners
    return len(words), len(covered), sorted(map(str, items))


def test_decontaminate_odd_rows(spark):
    docs = messy.frame(spark)
    texts = [r[1] for r in messy.rows() if r[1]]
    items = [(1, texts[0][10:150]), (2, texts[1]), (3, "été"), (4, "Walk green  7"), (5, None), (6, ""), (7, "..."), (None, texts[2]), (2, texts[4][:80]), (11, texts[0][40:150]), (12, "house of stone und")]
    found = windows_of([i for i in items if i[0] is not None])
    want = Counter((r[0], *hit(r[1], found)[:2], tuple(hit(r[1], found)[2])) for r in messy.rows())
    bench = spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, n_words long")
    got = winnow.decontaminate(docs, bench).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in got) == want
    assert winnow.decontaminate(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert winnow.decontaminate(messy.empty(spark), bench).count() == 0


def test_decontaminate_query(spark, sf):
    found = windows_of([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n, m, items = hit(r["text"], found)
        want[r["doc_id"]] = (n, m, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), m > 0)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in queries.op4_decontaminate(spark, sf).collect()}
    assert got == want


def cut(rows):
    """(n_bytes, kept bytes, spans) of each row, by brute force."""
    last = 2**63
    first = {}
    texts = [((r[0] if r[0] is not None else last), (r[1] or "").encode()) for r in rows]
    for doc, text in texts:
        for i in range(len(text) - 49):
            w = text[i : i + 50]
            first[w] = min(doc, first.get(w, last))
    out = []
    for doc, text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - 49):
            if first[text[i : i + 50]] < doc:
                gone[i : i + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((len(text), kept, len(re.findall(b"\x01+", bytes(gone)))))
    return out


def test_suffix_odd_rows(spark):
    rows = messy.rows()
    want = Counter((r[0], n, n - len(k), s, hashlib.sha256(k).hexdigest()) for r, (n, k, s) in zip(rows, cut(rows)))
    got = suffix.dedup(messy.frame(spark)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    assert suffix.dedup(messy.empty(spark)).count() == 0


def test_suffix_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r[0]: (n, n - len(k), s, hashlib.sha256(k).hexdigest()) for r, (n, k, s) in zip(docs, cut(docs))}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op8_suffix(spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("crowded", [0, 40])
def test_crowded_anchors(spark, crowded):
    """A header in front of other text each time, and one inside of it: as by brute force, wherever windows meet."""
    rng = np.random.default_rng(crowded)
    words = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 9999, n))
    header, ends = words(30), [words(3) for _ in range(9)]
    rows = [(int(d), words(5) + " " + header + " " + (words(9) if d % 3 else ends[d % 9] + words(6))) for d in rng.permutation(400)] + [(None, header), (5, header)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter((r[0], n, n - len(k), s, hashlib.sha256(k).hexdigest()) for r, (n, k, s) in zip(rows, cut(rows)))
    got = suffix.dedup(docs, crowded=crowded).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_contexts_of_one_anchor_spread_over_buckets():
    """One anchor with 3000 contexts: the largest bucket holds a small share of its windows."""
    rng = np.random.default_rng(6)
    texts = [b"one passage of a header that many texts hold " + rng.integers(97, 123, 60).astype(np.uint8).tobytes() for _ in range(3000)]
    offsets = np.arange(len(texts) + 1) * len(texts[0])
    ids, data = np.arange(len(texts)), np.frombuffer(b"".join(texts), np.uint8)
    packed = suffix._batch(segment=[0], data=[suffix._pack(ids, ids, offsets, data)])
    gram, count = np.unique(suffix._short(suffix.runs(data, offsets, suffix.WINDOW)[4]), return_counts=True)
    value = gram[[count.argmax()]]
    kinds = {}
    for crowded in (False, True):
        wanted = pa.Table.from_batches([suffix._batch(segment=[0], data=[suffix._six(value | np.uint64(crowded)).tobytes()])])
        sent = pa.Table.from_batches(list(suffix._sorted_runs(0, wanted, pa.Table.from_batches([packed]), 64))).to_pylist()
        kinds[crowded] = [len(suffix._unpack(r["data"], *(suffix.WINDOWS if crowded else suffix.RUN))[-1]) for r in sent if r["kind"] == 2 * crowded]
    assert len(kinds[False]) == 1 and kinds[False][0] > 1000
    assert len(kinds[True]) == 64 and max(kinds[True]) < 3 * sum(kinds[True]) / 64


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=4).map(lambda b: b.translate(bytes(x & 1 for x in range(256)))), max_size=8), max_size=6))
def test_merge_is_sorted_and_knows_prefixes(runs):
    runs = [sorted(r) for r in runs]
    shared = [[suffix._common(r[i - 1], x, 0) if i else 0 for i, x in enumerate(r)] for r in runs]
    got = [(runs[r][i], n) for r, i, n in suffix.merge(runs, shared)] if runs else []
    assert [x for x, _ in got] == sorted(x for r in runs for x in r)
    assert all(n == suffix._common(got[i - 1][0] if i else b"", x, 0) for i, (x, n) in enumerate(got))


def shingles(text, n=5):
    words = low(text).split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def test_near_duplicates(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    left = {r["doc_id"] for r in simhash.near_duplicates(docs).collect()}
    like = lambda a, b: len(rows[a] & rows[b]) / len(rows[a] | rows[b])
    links = [(a, b) for a in rows for b in rows if a < b and like(a, b) >= 0.8]
    assert left == {d for d, top in groups(links, rows).items() if d == top}


def test_stages_keep_columns_and_odd_rows(spark, sf):
    docs = messy.frame(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert stage(spark, messy.empty(spark), sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, messy.empty(spark), sf).count() == 0
    near = corpus_pipeline.one_of_near_copies(spark, docs, sf)
    ids = [r["doc_id"] for r in near.collect()]
    assert not set(range(200, 206)) & set(ids) and not {401, 402} & set(ids)
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_repeats(spark, docs, sf).collect()}
    assert texts[400] is None and texts[401] == "" and 200 not in texts and all("�" not in (t or "") for t in texts.values())
    first = messy.rows()[7][1]
    assert first[60:100] not in texts[301] and texts[7 * 3] == first


def test_pipeline_of_the_small_table(spark, sf):
    """The rows of run() against the stages' own rules, applied in plain Python where they allow it."""
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, docs, sf).collect()
        kept.append({r["doc_id"]: r["text"] for r in rows})
        docs = spark.createDataFrame(rows, docs.schema)
    cleaned = dict(zip(kept[1], (k for _, k, _ in cut(list(kept[1].items())))))
    assert kept[2] == {d: t for d, k in cleaned.items() if (t := k.decode("utf-8", "ignore")).strip() or k == kept[1][d].encode()}
    found = windows_of([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert set(kept[3]) == {d for d, t in kept[2].items() if not hit(t, found)[1]}
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf).collect():
        got[r["doc_id"]] += r["size"]
    assert got == {d: len(t.encode()) + 1 for d, t in kept[3].items()}


def altered(seed=8, vocabulary=20_000):
    """(doc_id, text): texts over a large vocabulary, each with an appended, a truncated, an edited and a half-shared version."""
    rng = np.random.default_rng(seed)
    words = lambda n: [f"w{x}" for x in rng.integers(0, vocabulary, n)]
    out = []
    for n in rng.integers(60, 400, 250).tolist():
        base, share = words(n), rng.uniform(0.8, 0.97)
        edited = list(base)
        for at in rng.integers(0, n, max(1, int((n - 4) * (1 - share) / 12))):
            edited[at] = words(1)[0]
        for text in (base, base + words(int(n * (1 / share - 1))), base[: int(n * share)], edited, base[: int(n * rng.uniform(0.62, 0.79))]):
            out.append((len(out), " ".join(text)))
    return out


def pairs_of(rows, least):
    """Pairs with their likeness by an exact join over shingles."""
    held, by = {d: shingles(t) for d, t in rows}, defaultdict(list)
    for d, s in held.items():
        for x in s:
            by[x].append(d)
    both = Counter((a, b) for ds in by.values() for i, a in enumerate(ds) for b in ds[i + 1 :])
    like = {(a, b): n / (len(held[a]) + len(held[b]) - n) for (a, b), n in both.items()}
    return {p: x for p, x in like.items() if x >= least}


def test_near_duplicates_against_a_shingle_join(spark):
    rows = altered()
    like = pairs_of(rows, 0.8)
    assert sum(x < 0.85 for x in like.values()) > 100
    left = {r["doc_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not [p for p in like if left.issuperset(p)]
    group = groups(like, [d for d, _ in rows])
    assert left == {d for d, top in group.items() if d == top}


@pytest.mark.parametrize("few, width", [(24, 4096), (0, 7), (3, 50), (10**6, 1)])
def test_shared_counts(monkeypatch, few, width):
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "SLICE", width)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, [5, 300, 9000][i % 3], rng.integers(0, 200))).astype(np.uint64) for i in range(90)]
    got = simhash.shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(x, y)) for i, x in enumerate(sets) for j, y in enumerate(sets) if i != j)
    assert simhash.shared_counts([]).shape == (0, 0)


def crowd(rng, n, likeness, planted, twins, words=1000):
    """Texts with a common core, any two of them ``likeness`` alike, and ``twins`` pairs that are ``planted`` alike."""
    total = words - 4
    core, more = (round(2 * total * j / (1 + j)) for j in (likeness, planted))
    fresh = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    head, out = fresh(core + 4), []
    for i in range(n):
        extra = fresh(more - core) if i < 2 * twins and i % 2 == 0 else extra if i < 2 * twins else []
        text = head + extra
        out.append((i, " ".join(text + fresh(words - len(text)))))
    return out


@pytest.mark.parametrize("n, block, planted", [(600, 1024, 0.8225), (600, 100, 0.8225), (300, 64, 0.805)])
def test_pairs_in_a_crowd_of_nearly_alike_texts(spark, monkeypatch, n, block, planted):
    """Everybody shares a core (0.7786); only the planted pairs are near copies, and none of them is lost."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = crowd(np.random.default_rng(n + block), n, 0.7786, planted, 50)
    left = {r["doc_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert left == set(range(n)) - {2 * k + 1 for k in range(50)}


@pytest.mark.parametrize("n, sides", [(40, (2,)), (700, (2,)), (700, (0, 1))])
def test_plausible_pairs_of_a_group(n, sides):
    rng = np.random.default_rng(n)
    centre, pick = rng.integers(0, 2**63, (9, 3)), rng.integers(0, 9, n)
    flips = 1 << rng.integers(0, 62, (n, 3, 3))
    sketch = [np.bitwise_xor.reduce(np.concatenate([centre[pick, k, None], flips[:, k]], 1), axis=1) for k in range(3)]
    side, node = rng.choice(sides, n), rng.permutation(n)
    got = groups(zip(*(x.tolist() for x in simhash._plausible(20)(np.zeros(n, int), side, node, *sketch))), range(n))
    apart = simhash._differ([s[:, None] for s in sketch], [s[None] for s in sketch])
    meet = (side[:, None] != side[None]) | (side[:, None] == 2)
    a, b = np.nonzero((apart <= 20) & meet)
    assert len(set(got.values())) < n and got == groups(zip(node[a].tolist(), node[b].tolist()), range(n))


def test_candidates_of_the_near_copy_stage_are_simhash_prints(spark, sf, monkeypatch):
    """Near copies are found by their prints alone: when these say nothing, every text stays."""
    prints, chosen = simhash.prints_for(10**6, 0.8)
    assert prints >= 16 and sorted(sum(chosen.parts, [])) == list(range(64)) and not any(chosen.thresholds)
    assert [len(simhash.prints_for(n, 0.8)[1].parts) for n in (0, 10**6, 10**7, 10**8)] == [5, 5, 4, 3]
    rows = altered(3)[:100]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert corpus_pipeline.one_of_near_copies(spark, docs, sf).count() < len(rows)
    monkeypatch.setattr(simhash, "majority", lambda hashes, bounds: np.random.default_rng().integers(-(2**63), 2**63, len(bounds) - 1))
    assert corpus_pipeline.one_of_near_copies(spark, docs, sf).count() == len(rows)


def test_prints_of_pairs_of_just_the_similarity():
    """Of 3000 pairs of just 0.8, small sets among them, few are lost by parts of prints or by the sketch; unlike ones are told apart."""
    rng = np.random.default_rng(12)
    prints, chosen = simhash.prints_for(1000, 0.8)
    limit, lost, near = simhash.unlike(0.8), 0, 0
    masks = [np.uint64(sum(1 << b for b in part)) for part in chosen.parts]
    for n in (4, 8, 80) * 1000:
        more = rng.integers(0, 2**63, n + n // 4, np.uint64)
        sets, bounds = np.concatenate([more[:n], more, rng.integers(0, 2**63, n, np.uint64)]), np.array([0, n, len(more) + n, len(more) + 2 * n])
        got = np.stack([simhash.majority(simhash.mix(sets + np.uint64(k)), bounds) for k in range(3, prints + 3)], 1).view(np.uint64)
        shares = any(((got[0] ^ got[1]) & m == 0).any() for m in masks)
        apart = [int(simhash._differ([x[:1] for x in got[[0]].T[:2]], [x[:1] for x in got[[k]].T[:2]])[0]) for k in (1, 2)]
        lost += not shares or apart[0] > limit
        near += n == 80 and apart[1] <= limit
    assert lost <= 12 and near <= 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_rows_of_near_copies_are_shuffled_once(spark):
    """Choosing the rows that stay and counting equal ones once need one shuffle of the rows, keyed alike."""
    rows = [(d, t, str(k)) for k, (d, t) in enumerate(altered(5)[:60] * 2)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
        assert plan_of(out).count("Exchange hashpartitioning") == 2
        left = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len({r["doc_id"] for r in left}) == len(left) and all((r["doc_id"], r["text"], r["lang"]) in rows for r in left)


def test_a_hub_names_itself_once(spark, monkeypatch):
    """Rows and hubs that _crowds joins: no pair comes twice, however many rows a hub has."""
    seen = []
    monkeypatch.setattr(simhash, "_crowds", lambda members, of=simhash._crowds: seen.append(members.collect()) or of(members))
    rows = crowd(np.random.default_rng(4), 200, 0.9, 0.95, 0, words=200)
    assert simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == 1
    assert seen[0] and len(seen[0]) == len(set(seen[0]))


def test_links_of_a_crowd_are_held_as_stars(monkeypatch):
    """However few links a task may hold, the same pairs and the same hubs come out."""
    rng = np.random.default_rng(12)
    centre, n = rng.integers(0, 2**63, (90, 2)), 900
    pick = np.where(np.arange(n) < 700, rng.integers(0, 4, n), rng.integers(4, 90, n))
    sketch = [centre[pick, k] ^ (1 << rng.integers(0, 62, n)) for k in range(2)]
    found = {}
    for held in (10**9, 3000):
        monkeypatch.setattr(simhash, "LINKS", held)
        pairs = zip(*(x.tolist() for x in simhash._plausible(20)(np.zeros(n, int), np.full(n, 2), np.arange(n), *sketch)), strict=True)
        found[held] = sorted(pairs)
    a, b = np.array(found[3000]).T
    assert found[10**9] == found[3000] and (a > b).sum() > 600 and (a < b).sum() > 50


@pytest.mark.parametrize("bits", [15, 17, 25])
def test_bits_ahead_of_the_shuffle_lose_no_text(spark, monkeypatch, bits):
    monkeypatch.setattr(simhash, "ASKED_BITS", bits)
    node = [*np.random.default_rng(bits).integers(-(2**63), 2**63, 5000).tolist(), -1, 0, 2**63 - 1, -(2**63)]
    rows, asked = spark.createDataFrame([(n, str(n)) for n in node * 2], "node long, text string"), node[4500:]
    got = Counter(r["node"] for r in simhash._maybe_in(rows, spark.createDataFrame([(n,) for n in asked], "node long")).collect())
    assert got.keys() >= set(asked) and set(got.values()) == {2}
    assert len(got) < len(asked) + (5000 if bits == 15 else 200)
    assert simhash._maybe_in(rows, spark.createDataFrame([], "node long")).count() == 0


def test_sets_go_only_where_they_are_asked_for(spark):
    kept = spark.createDataFrame([(d, d, t) for d, t in altered(6)[:6]], "doc_id long, hash long, text string")
    node = [r[0] for r in kept.selectExpr("xxhash64(doc_id, hash)").collect()]
    asked = [(node[0], simhash.FIRST), (node[1], simhash.SECOND | simhash.MEMBER), (node[2], simhash.MEMBER)]
    held = simhash._held_sets(kept.union(kept), spark.createDataFrame(asked, "node long, uses int"), 5)
    assert sorted((r["node"], r["uses"]) for r in held.collect()) == sorted(asked)
    assert all(r["size"] == len(r["grams"]) > 0 for r in held.collect())
    got = {use: {r["node"] for r in simhash._held_for(held, use).collect()} for use in (simhash.FIRST, simhash.SECOND, simhash.MEMBER)}
    assert got == {1: {node[0]}, 2: {node[1]}, 4: {node[1], node[2]}}


def test_few_dirty_ids_do_not_shuffle_the_texts(spark):
    """The ids that share a window with an item are a small table to Spark, whatever the scanned texts measure."""
    passage = " ".join(f"p{x}" for x in range(12))
    rows = [(d, t) for d, t in altered(7)[:400]] + [(9999, passage), (None, passage)]
    docs, items = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, passage)], "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2k")
    try:
        out = winnow.clean(docs, items)
        assert re.search("BroadcastHashJoin.*LeftAnti", plan_of(out))
        assert {r["doc_id"] for r in out.collect()} == {d for d, _ in rows} - {9999, None}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
