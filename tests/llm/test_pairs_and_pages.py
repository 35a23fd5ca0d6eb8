"""Operators 2, 7 and 9, and the pipeline, against brute force on small tables."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargomart.llm import html_extract, minhash, search
from cargomart.llm.components import components

from .conftest import TEXTS

LOWER = re.compile("[A-Z]")


def plain_set(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", LOWER.sub(lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])


def plain_groups(links, nodes):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        up[max(top(a), top(b))] = min(top(a), top(b))
    return {x: top(x) for x in nodes}


def plain_near(rows, n, percent):
    sets = [plain_set(t, n) for _, t in rows]
    alike = [
        (a, b) for a, b in combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    group = plain_groups(alike, range(len(rows)))
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[group[k]] = min(i, ids.get(group[k], i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = ids.get(group[k]) if sets[k] else i
        out.append((i, len(sets[k]), c, i is not None and i == c))
    return sorted(out, key=str)


def chains(rng, n):
    """Copies of few texts, edited a little, some of them again and again, so
    that groups hang together by a few links only."""
    texts = [" ".join(rng.choices([f"v{k}" for k in range(60)], k=rng.randint(20, 60))).split() for _ in range(4)]
    for _ in range(n - 4):
        t = list(rng.choice(texts[:4] if rng.random() < 0.5 else texts[-6:]))
        for _ in range(rng.randint(0, 2)):
            t[rng.randrange(len(t))] = f"v{rng.randint(0, 400)}"
        texts.append(t)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("seed, n, percent", [(1, 3, 85), (2, 5, 80)])
def test_groups_are_those_of_all_pairs(spark, seed, n, percent):
    rng = random.Random(seed)
    rows = [(1000 - i, t) for i, t in enumerate(chains(rng, 120))]
    rows += [(i, t) for i, t, _ in TEXTS] + [(2000 + i, rows[0][1].upper()) for i in range(40)]
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], "doc_id long, text string, node string, key string").repartition(4)
    got = minhash.near_duplicates(df, n, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=str) == plain_near(rows, n, percent)


def test_no_documents_have_no_groups(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def test_estimates_are_near_the_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for share in (0, 300, 600, 900):
        a, b = pool[:1000], np.concatenate([pool[:share], pool[1000 : 2000 - share]])
        h, bounds = np.concatenate([a, b]), np.array([0, 1000, 2000])
        x, y = minhash.pack(minhash.minima(h, bounds))
        diff = x ^ y
        ones = np.uint64(0x5555555555555555)
        apart = int(np.bitwise_count((diff | (diff >> np.uint64(1))) & ones).sum())
        estimate = (1 - apart / minhash.HASHES - 0.25) / 0.75
        assert abs(estimate - share / (2000 - share)) < 0.2


def test_parity_sketches_never_differ_in_more_places_than_the_sets():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    for _ in range(200):
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 900))) for _ in range(2))
        apart = int(np.bitwise_count(minhash.parity(a) ^ minhash.parity(b)).sum())
        assert apart <= len(np.setxor1d(a, b)) and (apart - len(np.setxor1d(a, b))) % 2 == 0
    assert not minhash.parity(pool[:0]).any()


@pytest.mark.parametrize("seed", range(3))
def test_components_are_those_of_the_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    links += [(500, 500 + i) for i in range(40)] + [(3, 3)]
    nodes = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in got} == plain_groups([x for x in links if x[0] != x[1]], nodes) and len(got) == len(nodes)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_top(codes, queries, k):
    out = []
    for q in sorted(set(queries)):
        near = sorted((bin((q[1] ^ c) & ((1 << 64) - 1)).count("1"), i) for i, c in codes if i != q[0])[:k]
        out += [(q[0], rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return out


@pytest.mark.parametrize("n, k", [(300, 5), (7, 10), (1, 3)])
def test_nearest_codes_are_those_of_all_pairs(spark, n, k):
    rng = np.random.default_rng(n)
    codes = [(i, int(x)) for i, x in enumerate(rng.integers(-(1 << 63), 1 << 63, n))]
    codes += [(n + i, codes[0][1]) for i in range(n // 2)] + [(3 * n + i, codes[0][1] ^ (1 << (i % 63))) for i in range(n // 4)]
    queries = codes[:: max(1, n // 10)]
    df, q = (spark.createDataFrame(x, "vec_id long, code long") for x in (codes, queries))
    got = search.top_k(df, q, k).select("query_id", "rank", "vec_id", "distance").collect()
    assert sorted(map(tuple, got)) == sorted(plain_top(codes, queries, k))


@pytest.mark.parametrize("k", [1, 3, 10])
def test_nearest_codes_where_ids_are_repeated(spark, k):
    rng = np.random.default_rng(k)
    codes = [(i, int(x)) for i, x in enumerate(rng.integers(-(1 << 63), 1 << 63, 200))]
    # Equal rows of one id, of another after it, an id of several codes, and a far one.
    codes += [(100, codes[100][1])] * 11 + [(101, codes[100][1])] * 2 + [(3, codes[100][1] ^ 1)] * 4 + [(7, codes[100][1] ^ 6), (7, codes[50][1])] * 3
    queries = [codes[i] for i in (100, 101, 3, 50, 9)] + [(500, codes[100][1]), (101, codes[100][1])]
    df, q = (spark.createDataFrame(x, "vec_id long, code long") for x in (codes, queries))
    got = search.top_k(df, q, k).select("query_id", "rank", "vec_id", "distance").collect()
    want = []
    for query in sorted({i for i, _ in queries}):
        own = {c for i, c in queries if i == query}
        near = sorted((bin((x ^ c) & ((1 << 64) - 1)).count("1"), i) for x in own for i, c in codes if i != query)[:k]
        want += [(query, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) == 6 * k


def test_vectors_without_a_code_are_left_out(spark):
    ok = [1.0, -1.0] * 32
    rows = [(1, ok), (2, None), (3, ok[:9]), (4, [None, *ok[1:]]), (5, [float("nan"), *ok[1:]]), (None, ok), (6, [*ok, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["code"] for r in search.codes(df).collect()}
    assert set(got) == {1, 6} and got[1] == got[6] == int("10" * 32, 2) - (1 << 64)
    assert search.top_k(search.codes(df).limit(0), search.codes(df).limit(0)).count() == 0


PAGE = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>My Site</h1></header>
<div class="cookie-notice">We use cookies to improve. Accept them all please.</div><nav><a href="/">Home</a> <a href="/b">Blog</a></nav>
<div id="main"><h2>Story title</h2><p>First paragraph &eacute;t&nbsp;some words, and a sentence. Another &lt;one&gt;.<div class="ad">Buy now.</div>
<script>var a = "<p>no</p>";</script><p>Second   paragraph has a <a href="x">link</a> in<b>side</b>. It goes on and on for a while.</p></div>
<div class="sidebar"><p>Popular posts of the week, read them all today.</p></div><section class="comments"><h3>Comments</h3><p>Great article!</p></section>
<form><label>Email</label><button>Subscribe</button></form><footer>&copy; 2024 My Site. All rights reserved.</footer>"""


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "re") for b in ("ne", "sa", "ku", "wem", "li")]
    prose = lambda n: " ".join(rng.choices(words, k=n)).capitalize() + "."
    body = lambda: "".join(f"<p>{prose(rng.randint(8, 40))}</p>" for _ in range(4))
    rows = [(i, f"u{i}", f"<html><body><nav><a href=x>{prose(1)}</a></nav><article>{body()}</article></body></html>", "?") for i in range(60)]
    rows += [(100, "u", PAGE, "?"), (101, "u", None, "?"), (102, None, "", "?"), (103, "u", "<<<>&amp;<p", "?"), (100, "u", PAGE, "?"), (None, "u", "<nav>a", "?")]
    rows += [(104, "u", "<div>" * 3000 + "deep words here and there." + "</div>" * 10, "?")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


def test_the_article_comes_out_whole_and_alone(pages):
    model = html_extract.train(pages, layouts=300)
    rows = html_extract.extract(pages, model).collect()
    assert len(rows) == pages.count()
    got = {r["page_id"]: r["text"] for r in rows}
    want = "Story title First paragraph ét some words, and a sentence. Another <one>. Second paragraph has a link inside. It goes on and on for a while."
    assert got[100] == want and got[101] == got[102] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    for r in pages.where("page_id < 60").collect():
        assert got[r["page_id"]] == " ".join(re.findall("<p>(.*?)</p>", r["html"]))


def test_held_out_layouts_are_labelled_right(pages):
    model = html_extract.train(pages, layouts=300)
    made = html_extract._Layout([f"some other words of text number {i}, and a few more of them." for i in range(40)], random.Random(77))
    wrong = total = 0
    for _ in range(80):
        x, y = made.page()
        wrong += sum(a != b for a, b in zip(model.decode(x), y))
        total += len(y)
    assert wrong <= 0.04 * total


def test_no_pages(spark, pages):
    none = pages.limit(0)
    assert html_extract.extract(none, html_extract.train(none, layouts=20)).count() == 0


def test_blocks_end_where_the_document_tree_says():
    got = [b[0] for b in html_extract.blocks("<p>a<p>b <i>c</i><ul><li>d<li>e</ul>f<br>g<table><tr><td>h<td>i</table><title>no</title>&lt;j")]
    assert " ".join(got) == "a b c d e f g h i <j" and "b c" in got


@pytest.mark.parametrize(
    "html, text",
    [
        ("<html><head lang=en><title>no</title><meta charset=x><style>p{}</style><p>a<p>b", "a b"),
        ("<head><script>x</script><noscript><img></noscript><link rel=x><template><p>no</p></template>some <b>words</b><p>c", "some words c"),
        ("<head><title>no</title></head><body><p>a", "a"),
        ("<head><title>no</title><article><h1>T</h1>c</article>", "T c"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds<object data=f><p>fallback</p></object>", "so x=2 holds fallback"),
    ],
)
def test_text_after_an_open_head_and_formulas_are_kept(html, text):
    assert " ".join(b[0] for b in html_extract.blocks(html)) == text


def test_copyright_words_count_wherever_they_stand():
    found = [("word " * 200 + words, frozenset(), 0) for words in ("Copyright 2024", "All rights reserved", "no more")]
    number = html_extract._number()["copyright"]
    assert [number in x for x in html_extract.rows(found)] == [True, True, False]


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(6)
    calm = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(240):
        text = " ".join(rng.choices(calm, k=rng.randint(12, 40)))
        if i % 6 == 0:
            text += " grumble grumbled"
        rows.append((i, text + f" mail me{i}@example.org", "en", f"s{i % 3}"))
        labels.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[1][1], "en", "s0") for i in range(30)] + [(2000, None, None, None), (2001, "", "en", "s0"), (1, rows[1][1], "en", "s1")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        assert name == "packing" or docs.columns == names
    ids = lambda name: [r["doc_id"] for r in seen[name]]
    toxic = {i for i, _, y in labels if y}
    assert len(toxic & set(ids("toxicity"))) <= 1 and len(set(ids("toxicity")) - toxic) >= len(rows) - len(toxic) - 3
    assert set(ids("near_dedup")) == set(ids("toxicity")) - {1000 + i for i in range(30)} and ids("near_dedup").count(1) == 1
    assert not any("@" in (r["text"] or "") for r in seen["personal_data"])
    assert all("<EMAIL>" in r["text"] for r in seen["personal_data"] if r["text"])
    assert max(ids("mixing").count(i) for i in set(ids("mixing"))) == 2 and 2000 not in ids("mixing")
    assert sorted(ids("packing")) == sorted(ids("mixing"))
    assert len({r["sequence_id"] for r in seen["packing"]}) <= -(-sum(r["length"] for r in seen["packing"]) // 1024) + 1


A = " ".join(f"word{i}" for i in range(60))
B = " ".join(f"other{i}" for i in range(60))


def test_the_pipeline_keeps_rows_not_ids(spark):
    import corpus_pipeline

    rows = [(3, "zz " + B), (7, B + " zz"), (7, A), (None, A + " end"), (9, A)]
    more = [(20, "C " + A.replace("word", "third")), (20, "C " + A.replace("word", "third")), (None, "D " + B.replace("other", "fifth")),
            (None, "E " + B.replace("other", "sixth")), (None, None), (None, None), (5, ""), (5, "")]
    schema = "doc_id long, text string, source string, _key string"
    docs = spark.createDataFrame([(*r, "s", "k") for r in rows + more], schema).drop("_key").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted([tuple(r)[:2] for r in got.collect()], key=repr)
    want = [(3, "zz " + B), (7, A), *[more[0]], more[2], more[3], (None, None), (None, None), (5, ""), (5, "")]
    assert kept == sorted(want, key=repr)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def test_the_pipeline_over_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    source.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
