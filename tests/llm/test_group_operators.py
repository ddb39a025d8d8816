"""SimHash, suffix arrays, language model, wrapper induction, decontamination, mixing, pipeline."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tessella.llm import components, decontam, hmm_lm, jaccard, mixing, simhash, suffix_dedup, wrapper
from tessella.llm import common as few_keys
from tessella.llm.common import words
from tessella.llm.grouping_sa import suffix_array
from tessella.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def docs_of(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)


# SimHash -------------------------------------------------------------------------------------------------------------


def plain_fingerprint(text, k=3):
    w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("text", ["", "A b", "one", "x Y z", "É é\tB b\nC c", "a a a a a a", "the quick brown fox " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text) and simhash.fingerprint(text.encode(), 5) == plain_fingerprint(text, 5)


def plain_components(prints, distance):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


@pytest.mark.parametrize("bucket_rows", [20_000, 6])
def test_close_pairs_lose_no_link(spark, bucket_rows):
    rng = random.Random(1)
    prints = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            prints.append(base)
            for b in rng.sample(range(64), rng.randint(0, 3)):
                base ^= 1 << b
    prints = sorted(set(prints))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = simhash.close_pairs(df, bucket_rows=bucket_rows).collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 3 for r in links)
    roots = {r.node: r.root for r in components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    got = [roots.get(p, p) for p in signed]
    want = plain_components(prints, 3)
    groups = lambda ids: sorted(sorted(k for k, x in enumerate(ids) if x == i) for i in set(ids))
    assert groups(got) == groups(want)


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(0).shuffle(order)
    links = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(7, 7)], "a long, b long")
    assert {r.root for r in components.connected_components(links).collect()} == {0}
    assert components.connected_components(links.limit(0)).count() == 0


def test_near_duplicates_and_edges(spark, edges, no_rows):
    got = simhash.near_duplicates(edges).collect()
    assert len(got) == edges.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[1] == by[5] == {1} and by[2] == by[3] == by[6] == {2}
    kept = simhash.one_of_each(edges)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edges.columns and ids.count(5) == 0 and ids.count(1) == 1 and ids.count(2) == 1 and ids.count(3) == 0
    assert simhash.near_duplicates(no_rows).count() == 0 and simhash.one_of_each(no_rows).count() == 0


def test_near_duplicates_of_real_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    rows = docs.collect()
    prints = [plain_fingerprint(r.text or "") for r in rows]
    root = plain_components(prints, 3)
    least = {x: min(r.doc_id for r, y in zip(rows, root, strict=True) if y == x) for x in set(root)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries()["op5_simhash"](spark, SF).collect()}
    assert got == {r.doc_id: (f"{p:016x}", least[x]) for r, p, x in zip(rows, prints, root, strict=True)}


def shingles(text, k=5):
    w = [x.decode() for x in words(text.encode())]
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


@pytest.mark.parametrize(("common", "bucket_rows", "broadcast_keys"), [(3, 20_000, 1_000_000), (1, 6, 0)])
def test_near_dedup_loses_no_similar_pair(spark, monkeypatch, common, bucket_rows, broadcast_keys):
    """The pipeline's stage against all pairs: Jaccard similarity 0.8 or more, also where fingerprints are far apart."""
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard.similar_links, "__defaults__", (bucket_rows,))
    monkeypatch.setattr(few_keys, "BROADCAST_KEYS", broadcast_keys)
    rng = random.Random(8)
    prose = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    passage, texts = prose(40), ["", "one two", "One  two"]
    for n in (6, 30, 90, 200, 400):
        for _ in range(5):
            base = prose(n) + passage * (n < 100)
            for changes in (0, 1, n // 60, n // 45, n // 30):
                w = list(base)
                for p in rng.sample(range(len(w)), changes):
                    w[p] = "new"
                texts.append(" ".join(w[rng.randrange(1 + n // 20) :]))
    sets, prints = [shingles(t) for t in texts], [plain_fingerprint(t, 5) for t in texts]
    near = [(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0]
    assert sum((prints[a] ^ prints[b]).bit_count() > 3 for a, b in near) > 20
    root = plain_components(prints, 3)
    for a, b in near:
        x, y = sorted((root[a], root[b]))
        root = [x if r == y else r for r in root]
    least = {r: min(k for k, x in enumerate(root) if x == r) for r in root}
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs_of(spark, texts), SF).collect()} == set(least.values())


def test_sketches_bound_unlike_shingles():
    rng = np.random.default_rng(5)
    for _ in range(300):
        pool = rng.integers(0, 2**64, 120, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 120))) for _ in range(2))
        (_, *x), (_, *y) = jaccard.sketch(a), jaccard.sketch(b)
        differ = sum(((i ^ j) & (2**64 - 1)).bit_count() for i, j in zip(x, y, strict=True))
        unlike = len(np.setxor1d(a, b))
        assert differ <= unlike
        if jaccard.similar(a, b, 0.8):
            assert unlike <= jaccard.unlike(len(a) + len(b), 0.8)


# Suffix arrays -----------------------------------------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(symbols):
    assert suffix_array(np.array(symbols, int)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def pasted(seed, n, alphabet):
    rng = random.Random(seed)
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(6)]
    out = []
    for _ in range(n):
        t = list("".join(rng.choice(base)[rng.randint(0, 30) : rng.randint(20, 80)] for _ in range(rng.randint(0, 4))))
        for _ in range(rng.randint(0, 2)):
            if t:
                t[rng.randrange(len(t))] = "é"
        out.append("".join(t))
    return [*out, None, "", "abc"]


@pytest.mark.parametrize(("alphabet", "hot"), [("abcdefgh", 50_000), ("ab", 50_000), ("abcdefgh", 3), ("a", 50_000)])
def test_repeats_equal_brute_force(spark, alphabet, hot):
    texts = pasted(len(alphabet) + hot, 50, alphabet)
    found = suffix_dedup.digest(suffix_dedup.remove_repeats(docs_of(spark, texts), window=20, seed=8, block=3, hot_contexts=hot))
    got = [tuple(r)[1:] for r in found.orderBy("doc_id").collect()]
    assert got == suffix_dedup.brute_force([(t or "").encode() for t in texts], 20) and sum(r[1] > 0 for r in got) > 5


def test_periodic_texts_are_few_rows(spark):
    """Long runs of one character or of a short period: right, and settled within their task."""
    rng = random.Random(6)
    noise = "".join(rng.choice("abcdefgh") for _ in range(300))
    texts = ["-" * 5000, noise + "=" * 900 + noise[:100], "ab" * 2000 + noise[50:], "xyz" * 700, "-" * 250 + "." * 150, noise[:199]]
    got = [tuple(r)[1:] for r in suffix_dedup.digest(suffix_dedup.remove_repeats(docs_of(spark, texts, 2))).orderBy("doc_id").collect()]
    assert got == suffix_dedup.brute_force([t.encode() for t in texts], 200)
    long = [b"-" * 3_000_000, b"ab" * 1_000_000]
    batch = suffix_dedup._batch(dk=np.array([1, 2]), t=suffix_dedup.pa.array(long))
    assert sum(b.num_rows for b in suffix_dedup._anchor_rows(200, 48)([batch])) < 200


def test_long_texts_in_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 50)
    rng = random.Random(8)
    shared = "".join(rng.choice("abcd") for _ in range(130))
    texts = ["".join(rng.choice("abcdefgh") for _ in range(100)) + shared[a:b] + "x" * 30 for a, b in ((0, 130), (20, 90), (50, 130))]
    suffix_dedup._powers.cache_clear()
    rows = suffix_dedup.anchors(texts[0].encode(), 20, 8)
    starts = sorted(s for first, last in zip(rows[3], rows[4], strict=True) for s in range(first, last + 1))
    assert starts == list(range(len(texts[0]) - 19))


def test_repeats_edge_cases(spark, edges, no_rows):
    rows = edges.select("doc_id", "text").collect()
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(edges)).collect()
    want = suffix_dedup.brute_force([(r.text or "").encode() for r in rows], 200)
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in got) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want, strict=True))
    assert suffix_dedup.remove_repeats(no_rows).count() == 0


# Language model -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("block_tokens", [300_000, 5, 1])
def test_recursions_against_enumeration(monkeypatch, block_tokens):
    """Whole sequences, also where the backward pass recomputes the forward one in segments."""
    monkeypatch.setattr(hmm_lm, "BLOCK_TOKENS", block_tokens)
    rng = np.random.default_rng(0)
    k, symbols = 3, 4
    normal = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(s) + 0.1)
    model = hmm_lm.Model(normal(k), normal(k, k), normal(k, symbols).T.copy())
    seqs = [np.array(x, np.uint16) for x in ([0], [1, 2], [3, 0, 1], [2, 2, 0, 1])]
    counts = np.zeros(k + k * k + symbols * k)
    hmm_lm.expected_counts(seqs, model, counts)
    want, logs = np.zeros_like(counts), []
    for s in seqs:
        paths = {}
        for path in itertools.product(range(k), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(s)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            paths[path] = p
        total = sum(paths.values())
        logs.append(math.log(total))
        for path, p in paths.items():
            want[path[0]] += p / total
            for t in range(len(s)):
                want[k + k * k + s[t] * k + path[t]] += p / total
                if t:
                    want[k + path[t - 1] * k + path[t]] += p / total
    assert np.allclose(hmm_lm.log_likelihoods(seqs, model), logs) and np.allclose(counts, want)


@pytest.mark.parametrize("head", [200_000, 20, 0])
def test_scores(spark, head):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["The", "cat", "sat", "on", "mat", "a", "dog"] + [f"r{rng.randint(0, 50)}"]) for _ in range(rng.randint(0, 40))) for _ in range(80)] + [None]
    tokens = [[*words((t or "").encode()), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    c = Counter(w for t, h in zip(tokens, held, strict=True) if not h for w in t)
    n, v = sum(c.values()), len(c)
    rows = hmm_lm.score_documents(docs_of(spark, texts), states=2, buckets=64, rounds=3, head=head).orderBy("doc_id").collect()
    for r, t, h in zip(rows, tokens, held, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    trained = [r for r in rows if not r.held_out]
    assert sum(r.score for r in trained) > sum(r.base_score for r in trained)


@pytest.mark.parametrize("head", [20, 1, 0])
def test_words_met_over_a_million_times(spark, head):
    texts = ["a " * 30_000] * 45 + ["a a b", "b c", "c"]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    c = Counter(w for t, h in zip(texts, held, strict=True) if not h for w in [*t.split(), None])
    n, v = sum(c.values()), len(c)
    assert c["a"] > 1_000_000
    for r in hmm_lm.score_documents(docs_of(spark, texts), states=2, buckets=64, rounds=1, head=head).collect():
        t = [*texts[r.doc_id].split(), None]
        assert (r.n_known, r.train_tokens) == (sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(k * math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w, k in Counter(t).items()), rel=1e-9)


@pytest.mark.parametrize("head", range(0, 9))
def test_least_count(spark, head):
    c = [1, 1, 3, 1024, 1025, 70_000, 70_000, 1 << 33]
    counts = spark.createDataFrame(list(enumerate(c)), "h long, c long")
    least = hmm_lm.least_count(counts, head)
    want = [x for x in sorted(set(c)) if sum(y >= x for y in c) <= head]
    assert [x for x in sorted(set(c)) if x >= least] == want


def test_model_is_a_distribution(spark):
    """Over all texts of up to two words, known and unseen, probabilities and the rest's bound sum to one."""
    rng = random.Random(3)
    seen = ["x", "y", "z"]
    texts = [" ".join(rng.choice(seen) for _ in range(rng.randint(0, 3))) for _ in range(60)]
    probes = ["", *seen, *(f"{a} {b}" for a in seen for b in seen)]
    rows = hmm_lm.score_documents(docs_of(spark, texts + probes), states=2, buckets=2, rounds=2).collect()
    p = {texts_or: 10**r.score for r in rows for texts_or in [(texts + probes)[r.doc_id]]}
    assert 0.3 < sum(p[t] for t in probes) < 1


def test_language_model_edges(spark, edges, no_rows):
    rows = hmm_lm.score_documents(edges, states=2, buckets=64, rounds=1).collect()
    assert len(rows) == edges.count() and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert next(r for r in rows if r.doc_id == 2).n_tokens == 1
    assert hmm_lm.score_documents(no_rows, states=2, buckets=64, rounds=1).count() == 0


# Pages -------------------------------------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div class="cookie-notice">We use cookies</div><!-- note <p>x</p> -->
<main><article id=post-1><h1>Title &amp; more</h1><p>First <b>bold</b>&nbsp;text
 here<br>line.<p>Second <a href="x">link</a> one.</p><div class="ad">Buy!</div><form><p>Mail</p><input></form>
<ul><li>item one<li>item two</ul><p>Share this</p><section class="comments"><p>Nice!</p></section></article></main>
<aside><p>Side</p></aside><script>if (a < b) document.write("<p>no</p>")</script><footer>&copy; all</footer></body></html>"""


def test_rules_of_extraction():
    tree = wrapper.parse(PAGE)
    got = [tree.text[k] for k in wrapper.content(tree)]
    assert got == ["Title & more", "First bold text here line.", "Second link one.", "item one", "item two", "Share this"]
    plain = wrapper.parse("<body><nav>menu</nav><div>one<p>two</div>three<div hidden><p>no</div><table><tr><td>c1<td>c2</table>")
    assert [plain.text[k] for k in wrapper.content(plain)] == ["one", "two", "three", "c1", "c2"]
    bare = wrapper.parse(
        "<body><div id=hd><a href=/>Home</a> <a href=/n>News</a></div><div class='wrap has-sidebar no-ads'><div class=article-header><h1>T</h1></div>"
        "<p>See <a href=x>this</a> long enough text.</p><div class=cookiebar>ok?</div></div><ol class=commentList><li>hi</ol></body>"
    )
    assert [bare.text[k] for k in wrapper.content(bare)] == ["T", "See this long enough text."]
    inner = wrapper.parse("<article><div class=article-header><h1>T</h1></div><p><a href=x>Only a link</a></p><div id=comments><p>c</p></div></article>")
    assert [inner.text[k] for k in wrapper.content(inner)] == ["T", "Only a link"]
    for odd in ("", "<", "<p", "a < b & c", "</div></p>text", "<p class='x>y", "<!-- open", "<script>never closed", "<div>" * 500 + "deep"):
        wrapper.content(wrapper.parse(odd))


def test_matching_is_maximal():
    rng = random.Random(5)

    def tree(n):
        t = wrapper.Tree()
        t.add(-1, "#root", "", False, -1)
        for _ in range(n):
            t.add(rng.randrange(len(t.label)), rng.choice("ab"), "", False, -1)
        return t

    def plain(a, b, i, j):
        if a.label[i] != b.label[j]:
            return 0
        m = [[0] * (len(b.children[j]) + 1) for _ in range(len(a.children[i]) + 1)]
        for x, c in enumerate(a.children[i]):
            for y, d in enumerate(b.children[j]):
                m[x + 1][y + 1] = max(m[x][y + 1], m[x + 1][y], m[x][y] + plain(a, b, c, d))
        return 1 + m[-1][-1]

    for _ in range(60):
        a, b = tree(rng.randint(0, 14)), tree(rng.randint(0, 14))
        assert len(wrapper.Matching(a, b).pairs) == plain(a, b, 0, 0)
    wide = tree(0), tree(0)
    for t, n in zip(wide, (90, 70), strict=True):
        for k in range(n):
            t.add(0, "ab"[k % 2], "", False, -1)
    assert len(wrapper.Matching(*wide).pairs) == plain(*wide, 0, 0)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_templates_are_induced_by_host(spark, broadcast_bytes):
    """Blocks without any telling name: constant ones go, varying ones stay, also on mirrored and on lone pages."""
    page = lambda k: f"<body><div>Welcome to our site</div><p>Story {k} began.</p>" + f"<p>More {k}.</p>" * (k % 3) + "<div>Call us now</div></body>"
    rows = [(k, f"http://Site.example:80/{k}", page(k)) for k in range(12)]
    rows += [(50 + k, "https://mirror.example/x", "<body><p>Only story</p></body>") for k in range(9)]
    rows += [(90, "https://lone.example/", page(90)), (91, None, page(91)), (92, "https://site.example/e", None), (93, "https://site.example/f", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", wrapper.F.lit(1)).withColumn("texts", wrapper.F.lit(2))
    got = {r.page_id: r for r in wrapper.main_text(df, broadcast_bytes=broadcast_bytes).collect()}
    assert len(got) == len(rows)
    assert all(got[k].text == "\n".join([f"Story {k} began."] + [f"More {k}."] * (k % 3)) for k in range(12))
    assert got[50].text == "Only story" and got[90].text.startswith("Welcome to our site\nStory 90") and got[91].text.startswith("Welcome")
    assert (got[92].text, got[92].n_chars, got[93].text) == ("", 0, "")
    assert wrapper.main_text(df.limit(0)).count() == 0


def test_versions_of_an_article_are_no_template(spark):
    """Near copies inside a marked article stay whole; without a mark, paragraphs that shorter pages never reach stay."""
    body = "<p>Shared one.</p><p>Shared two.</p>"
    rows = [(k, "http://a.example/", f"<body><article><p>Version {k}.</p>{body}</article></body>") for k in range(10)]
    rows += [(20 + k, "http://b.example/", f"<body><p>Version {k}.</p>{body}</body>") for k in range(10)]
    rows += [(40 + k, "http://b.example/", f"<body><p>Short {k}.</p></body>") for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.main_text(df).collect()}
    assert all(got[k] == got[20 + k] == f"Version {k}.\nShared one.\nShared two." for k in range(10))


def test_names_count_as_a_whole():
    """Innocent names, articles as a whole, several articles, a headline in the main part, nested adverts, formulas."""

    def text(page):
        tree = wrapper.parse(page)
        return [tree.text[k] for k in wrapper.content(tree)]

    for name in ("class='comment-on-law'", "id=search-results", "class='social-history'", "class=responsive", "class='notice board'"):
        assert text(f"<body><article {name}><p>Body.</p></article></body>") == ["Body."]
    assert text("<body><article><section class='comment-on-law'><p>a</p></section><section class='user-comments'><p>b</p></section></article>") == ["a"]
    assert text("<article><p>one</p></article><article><p>two</p></article><div>rest</div>") == ["one", "two"]
    assert text("<article><p>one</p><article class=comment><p>hm</p></article></article><article class='teaser small'>t</article>") == ["one"]
    assert text("<main><h1>Title</h1><article><p>x</p></article><p>Author</p></main><p>out</p>") == ["Title", "x", "Author"]
    assert text("<article><p>a <span class=ad>Buy <span>now</span> this</span> b</p></article>") == ["a b"]
    assert text("<article><p>a <span class=ad>Buy <span>now</p><p>b</p></article>") == ["a Buy now", "b"]
    assert text("<article><p>Let <math><mi>x</mi></math> be <button>big</button></p></article>") == ["Let x be big"]
    assert text("<div class=notice><article>All of it</article></div><p>© us</p>") == ["All of it"]
    assert text("<div class=sidebar><p>only this</p></div>") == ["only this"]
    assert text("<section class=related><article><p>t</p></article></section><article><p>a</p></article>") == ["a"]


def test_deep_and_wide_pages(spark):
    """No step recurses, and wide lists are matched."""
    deep = lambda k: "<body>" + "<div>" * 5000 + f"<p>Deep {k}</p><p>Same</p>" + "</div>" * 5000 + "</body>"
    wide = lambda k: "<body><ul>" + "".join(f"<li><p>Item {j if j % 3 else (j, k)}</p></li>" for j in range(1500 + k)) + "</ul></body>"
    rows = [(k, "http://deep.example/", deep(k)) for k in range(7)] + [(20 + k, "http://wide.example/", wide(k)) for k in range(7)]
    rows += [(40, "http://deep.example/", "<div>" * 3000 + "<ul><li>x" * 500)]
    got = {r.page_id: r.text for r in wrapper.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)).collect()}
    assert all(got[k] == f"Deep {k}" for k in range(7)) and got[40].count("x") == 500
    assert all(got[20 + k].startswith(f"Item (0, {k})\nItem (3, {k})\n") for k in range(7))


def test_wrapper_finds_what_no_name_tells(spark):
    """Adverts that take turns and menus without telling names go, on two layouts of a host; what varies stays."""
    ads = [f"Buy number {k} now" for k in range(4)]
    rows = []
    for k in range(30):
        top = f"<div class=x1>{ads[k % 4]}</div><div class=x2>Home - News - Contact</div>"
        rows.append((k, "http://news.example/", f"<body>{top}<h1>Headline {k}</h1><article><p>Story {k}.</p></article><div class=x3>All rights reserved</div></body>"))
        rows.append((100 + k, "http://news.example/", f"<body><table><tr><td>{ads[k % 3]}<td>Gallery</table><div class=g><p>Picture {k}</p></div>{top}</body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrapper.main_text(df).collect()}
    assert all(got[k] == f"Headline {k}\nStory {k}." and got[100 + k] == f"Picture {k}" for k in range(30))
    alone = {r.page_id: r.text for r in wrapper.main_text(df, min_pages=10**9).collect()}
    assert all(alone[k] == f"Story {k}." and alone[100 + k].startswith(ads[k % 3]) for k in range(30))


# Decontamination ----------------------------------------------------------------------------------------------------------


def brute_leak(text, items, span=13, similarity=0.8, min_words=5):
    t, out = decontam.tokens(text), set()
    for i, item in items:
        own = decontam.tokens(item)
        n = min(span, len(own))
        if len(own) < min_words:
            continue
        errors = int((1 - similarity) * n + 1e-9)
        windows = ((p, q) for p in range(len(t) - n + 1) for q in range(len(own) - n + 1))
        if any(sum(x != y for x, y in zip(t[p : p + n], own[q : q + n], strict=True)) <= errors for p, q in windows):
            out.add(i)
    return out


@pytest.mark.parametrize("slice_words", [2_000_000, 40, 3])
def test_leaks_equal_brute_force(spark, slice_words):
    """In one slice, in a few, and in over 50, each with at most one item or piece of one."""
    rng = random.Random(7)
    vocabulary = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 13, 20, 30])))) for k in range(12)] + [(77, None)]
    texts = []
    for _ in range(60):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.6:
            w = decontam.tokens((rng.choice(items)[1] or "").encode())
            w = [x.decode() for x in w][rng.randint(0, 3) :]
            for _ in range(rng.randint(0, 4)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t[rng.randint(0, len(t)) : 0] = [x.upper() + "," for x in w]
        texts.append(" ".join(t))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.find_leaks(docs_of(spark, [*texts, None]), benchmark, slice_words=slice_words).collect()
    named = benchmark.selectExpr("concat('item ', item_id) AS item_id", "text")
    by_name = decontam.find_leaks(docs_of(spark, [*texts, None]), named, slice_words=max(40, slice_words)).collect()
    assert {r.doc_id: {f"item {i}" for i in r.item_ids} for r in got} == {r.doc_id: set(r.item_ids) for r in by_name}
    raw = [(i, (t or "").encode()) for i, t in items]
    for r in got:
        want = brute_leak((r.text or "").encode(), raw)
        assert set(r.item_ids) == want and r.contaminated == bool(want) and r.n_items == len(want) and (r.overlap_words >= 5) == bool(want)
    assert sum(r.contaminated for r in got) > 5


def test_large_items_and_one_index_at_a_time(spark, monkeypatch):
    """Items beyond a slice are indexed in pieces; each index is given up before the next one is built."""
    events, sizes = [], []
    build, broadcast = decontam.SeedIndex.__init__, type(spark.sparkContext.broadcast(0))
    destroy = broadcast.destroy

    def counted(self, *args):
        build(self, *args)
        events.append("built")
        sizes.append(sum(map(len, self.ids)))

    monkeypatch.setattr(decontam.SeedIndex, "__init__", counted)
    monkeypatch.setattr(broadcast, "destroy", lambda self, blocking=False: (events.append("gone"), destroy(self, blocking))[1])
    rng = random.Random(1)
    item = [f"v{rng.randrange(10_000)}" for _ in range(900)]
    texts = [" ".join(item[k : k + 30]) for k in range(0, 870, 29)] + ["nothing of it here at all"]
    got = decontam.find_leaks(docs_of(spark, texts), spark.createDataFrame([("long", " ".join(item))], "item_id string, text string"), slice_words=30).collect()
    assert [r.contaminated for r in sorted(got, key=lambda r: r.doc_id)] == [True] * 30 + [False]
    assert len(sizes) >= 30 and max(sizes) < 300 and events == ["built", "gone"] * len(sizes)


def test_masks_lose_no_errors():
    for span, errors in ((13, 2), (5, 1), (9, 1), (6, 1)):
        groups, chosen = decontam.masks(span, errors)
        for wrong in itertools.combinations(range(span), errors):
            assert any(not {p for g in pick for p in groups[g]} & set(wrong) for pick in chosen)


def test_leak_edges(spark, edges, no_rows):
    benchmark = spark.createDataFrame([(1, "w0 w1 w4 w9 w16 w25")], "item_id long, text string")
    rows = decontam.find_leaks(edges, benchmark)
    assert rows.count() == edges.count() and {r.doc_id for r in rows.filter("contaminated").collect()} == {4}
    assert set(rows.columns) == set(edges.columns) | {"contaminated", "n_items", "overlap_words", "item_ids"}
    assert not decontam.find_leaks(edges, benchmark.limit(0)).filter("contaminated").count()
    assert decontam.find_leaks(no_rows, benchmark).count() == 0


# Mixing -------------------------------------------------------------------------------------------------------------------


def filled(sizes, weights, most=3):
    """Targets by rounds of clamping and resharing."""
    total, clamped = sum(sizes.values()), {}
    while True:
        left, w = total - sum(clamped.values()), sum(weights[s] for s in sizes if s not in clamped)
        share = {s: left * weights[s] / w for s in sizes if s not in clamped} if w else {}
        over = {s: most * sizes[s] for s in share if share[s] > most * sizes[s]}
        if not over:
            return clamped | share
        clamped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{k:02d}": rng.choice([0, 1, 5, 40, 1000, 9000]) for k in range(9)} | {"s99": 10}
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(sizes))}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(filled(sizes, weights))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries()[name](spark, SF).toPandas()
    want = con.sql(oracle_sql()[name]).df()
    assert set(got.columns) == set(want.columns)
    rows = lambda df: sorted(map(tuple, df[sorted(got.columns)].astype(str).values.tolist()))
    assert rows(got) == rows(want)


def test_mix_totals_and_edges(spark, edges, no_rows):
    rows = mixing.mix_sources(edges).collect()
    assert len(rows) == edges.count() and all(0 <= r.taken <= 3 * r.size for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - target) <= 1 for (_, target), v in by.items())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_sources(edges.repartition(5)).collect()))
    mixed = mixing.mix_documents(edges)
    assert sum(r.taken for r in mixed.collect()) == sum(r.taken for r in rows)
    assert set(mixed.columns) == set(edges.columns) and mixing.mix_documents(no_rows).count() == 0 and mixing.mix_sources(no_rows).count() == 0


def test_mixed_rows_keep_their_own_share(spark):
    """Rows that share doc_id and size across sources, and rows that are equal in every column, against running sums."""
    rng = random.Random(4)
    rows = [(1, "a b c", "large", "x"), (1, "d e f", "small", "x")] + [(k, "w " * 50, "large", "y") for k in range(2, 12)]
    rows += [(20 + k % 5, "v " * rng.randint(1, 9), rng.choice(["large", "small", None, "third"]), "z") for k in range(300)]
    rows += [(50, "same words here", "third", "z")] * 7 + [(60, None, "large", "z"), (None, "no id", "third", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key string").repartition(4)
    shares = {}
    for r in mixing.mix_sources(df).collect():
        shares.setdefault((str(r.doc_id), r.size, r.source_size), []).append(r.taken)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    got, total = {}, {}
    for r in mixing.mix_documents(df).collect():
        size = len(r.text.split())
        got.setdefault((str(r.doc_id), size, sizes[r.source]), []).append(r.taken)
        total[r.source] = total.get(r.source, 0) + r.taken
        assert r.copies == -(-r.taken // size)
    names = sorted(s for s in sizes if s is not None)
    target = filled(sizes, {s: (1, 2, 3)[k % 3] for k, s in enumerate([*names, None])})
    assert all(abs(total[s] - target[s]) <= 1 for s in sizes)
    # Which of rows that share id and size is cut is free; where no row is cut, shares are those of the plain operator.
    assert {k: sum(v) for k, v in got.items()}.keys() <= {k for k, v in shares.items() if sum(v)}
    two = {(r.doc_id, r.source): r.taken for r in mixing.mix_documents(df.filter("doc_id < 12")).collect()}
    assert two[1, "small"] == 9 and two.get((1, "large"), 0) <= 3 and abs(sum(v for (_, s), v in two.items() if s == "large") - 497) <= 1


# Pipeline and queries ---------------------------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    states = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(states[-1], docs.schema), SF)
        assert name == "source_mixing" or out.columns == columns
        states.append(out.collect())
    quality, lines, near, clean, mixed = states[1:]
    kept = {r.doc_id for r in quality}
    assert sum(q == 1 and i in kept for i, q in labels.items()) >= 0.95 * sum(labels.values())
    seen = {r.text for r in lines}
    assert len(seen) == len(lines) or "" in seen
    prints = [plain_fingerprint(r.text or "", 5) for r in near]
    assert len(set(plain_components(prints, 3))) == len(near)
    items = [(r.item_id, r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {r.doc_id for r in near if not brute_leak(r.text.encode(), items)} == {r.doc_id for r in clean}
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean} and all(r.taken > 0 and 1 <= r.copies <= 3 for r in mixed)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id for r in mixed}


@pytest.mark.parametrize("stage", [f for n, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_cases(spark, edges, no_rows, stage):
    got = stage(spark, edges.withColumnRenamed("taken", "taken2").withColumnRenamed("copies", "copies2"), SF)
    got.collect()
    assert stage(spark, no_rows, SF).count() == 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_give_one_row_for_each_input(spark, name):
    n = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op8') else 'documents'}.parquet").count()
    assert queries()[name](spark, SF).count() == n
