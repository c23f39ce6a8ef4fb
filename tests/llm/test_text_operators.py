import os
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from repsmith.llm import decontaminate, html_blocks, line_frequency, minhash_dedup, sparse_suffix, token_counts, toxicity_pu
from repsmith.llm._common import marked
from repsmith.llm.queries import tokenizer

DOCS = "doc_id long, text string, node string, _id string, score string"


def docs_of(spark, rows):
    """With further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], DOCS)


rnd = random.Random(5)
WORDS = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 7))) for _ in range(4000)]


def text(n, seed):
    return " ".join(random.Random(seed).choices(WORDS, k=n))


def edited(t, n, seed):
    r, w = random.Random(seed), t.split()
    for i in r.sample(range(len(w)), n):
        w[i] = "EDIT%d" % r.randrange(10 ** 6)
    return " ".join(w)


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)], i == least[find(k)]) for k, (i, s) in enumerate(sets))


def test_near_duplicates_equal_brute_force(spark):
    base = text(150, 1)
    rows = [(i, text(rnd.randint(1, 200), 100 + i)) for i in range(60)]
    rows += [(200 + i, edited(base, i % 4, i)) for i in range(60)]  # pairs on both sides of the threshold
    rows += [(300, base.upper().replace(" ", " \n")), (301, None), (302, ""), (303, " \t"), (304, "one two"), (305, "One  two"), (306, "\x0bé É")]
    rows += [(r[0] + 1000, r[1]) for r in rows[:5]] + [rows[3]]
    got = minhash_dedup.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == components(rows)
    stay = minhash_dedup.drop_near_duplicates(docs_of(spark, rows))
    assert stay.columns == docs_of(spark, []).columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted({r[0] for r in components(rows) if r[3]})


def test_near_duplicates_null_ids_and_empty(spark):
    same = text(40, 3)
    got = minhash_dedup.near_duplicates(docs_of(spark, [(None, same), (5, same), (None, text(30, 4))])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in got if r.n_shingles == 36) == [(-1, 5, False), (5, 5, True)]
    assert minhash_dedup.near_duplicates(docs_of(spark, [])).count() == 0


def test_nul_is_a_word_character(spark):
    rows = [(1, "a\x00b c d e f g"), (2, "a b c d e f g"), (3, "a\x00b c d e f g")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {1: (2, 1), 2: (3, 2), 3: (2, 1)}


def test_marked_misses_no_wanted_key(spark):
    rows = spark.range(0, 20000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("_map"))
    wanted = rows.where("k is null or k % 7 = 0").select(F.col("k").alias("w"))
    got = marked(rows, [F.col("k")], wanted.unionByName(wanted), [F.col("w")])
    assert got.columns == ["k", "_map", "_maybe"]
    found = {r.k: r._maybe for r in got.collect()}
    assert len(found) == 20000 and all(found[k] for k in found if k is None or k % 7 == 0)
    assert sum(found.values()) < 2858 + 50
    assert not any(r._maybe for r in marked(rows, [F.col("k")], wanted.limit(0), [F.col("w")]).collect())


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (50, 60), (60, 50)]
    got = {r.node: r.root for r in minhash_dedup.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 50: 50, 60: 50}


def test_repeated_passages(spark):
    passage, inner = text(70, 11), text(55, 12)
    rows = [(i, text(120, 500 + i)) for i in range(20)]
    for i in (3, 8, 12, 17):
        rows[i] = (i, f"{text(30 + i, 900 + i)} {passage}\n{text(40, 950 + i)}")
    rows[5] = (5, f"{inner} {text(33, 7)} {inner.upper()}")
    rows += [(30, None), (31, ""), (None, passage), (32, "junk " * 300), (8, rows[8][1]), (33, text(49, 77)), (34, text(49, 77))]
    got = sparse_suffix.repeated_passages(docs_of(spark, rows)).collect()
    words = {i: (t or "").lower().split() for i, t in rows if i is not None}
    for r in got:
        a = words[r.doc_id][r.start_word:r.start_word + r.n_words]
        assert len(a) == r.n_words >= 50 and a == words[r.source_id][r.source_start:r.source_start + r.n_words]
        assert (r.source_id, r.source_start) < (r.doc_id, r.start_word)
    assert {r.doc_id for r in got if r.doc_id < 30} == {5, 8, 12, 17}
    assert all(r.n_words >= 70 for r in got if r.doc_id in (8, 12, 17))
    cut = {r.doc_id: r.text for r in sparse_suffix.without_repeats(docs_of(spark, rows)).where("doc_id <> 32").collect()}
    assert passage in cut[3] and all(passage not in cut[i] for i in (8, 12, 17)) and cut[5].lower().count(inner) == 1
    assert cut[0] == rows[0][1] and cut[30] is None
    assert sparse_suffix.repeated_passages(docs_of(spark, [])).count() == 0


def covered(rows):
    """Per document the words of every 50-word window that stands at an earlier (doc_id, position) too."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        w = t.lower().split()
        for at in range(len(w) - 49):
            key = tuple(w[at:at + 50])
            if key in seen:
                out.setdefault(i, set()).update(range(at, at + 50))
            seen.add(key)
    return out


def spans_cover(spark, rows):
    got = {}
    for r in sparse_suffix.repeated_passages(docs_of(spark, rows)).collect():
        a, b = (dict(rows)[i].lower().split()[at:at + r.n_words] for i, at in ((r.doc_id, r.start_word), (r.source_id, r.source_start)))
        assert a == b and len(a) == r.n_words >= 50 and (r.source_id, r.source_start) < (r.doc_id, r.start_word)
        got.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    return got


def test_repeated_passages_of_families_around_one_core(spark):
    rows = []
    for k in range(8):  # 8 cores; 10 families of documents, with 6 words of their own before or after the core
        for i in range(30):
            own = text(6, 5000 + 10 * k + i % 10)
            rows.append((100 * k + i, " ".join([text(40, 10000 + 100 * k + i), *([own, text(45, 40 + k)] if k % 2 else [text(45, 40 + k), own]), text(40, 20000 + 100 * k + i)])))
    want = covered(rows)
    assert len(want) == 160 and spans_cover(spark, rows) == want


def test_repeated_passages_of_periodic_text(spark):
    line = text(12, 50)
    rows = [(i, f"{text(20, 8000 + i)} {line} {' '.join([line] * 49)} {text(20, 8100 + i)}") for i in (1, 2, 3)]
    rows += [(4, "junk " * 300), (5, "junk " * 20000), (6, f"{text(30, 51)} {'a b c ' * 40}{text(30, 52)}"), (7, " ".join([text(40, 53)] * 5))]
    want = covered(rows)
    assert {i: len(w) for i, w in want.items()} == {1: 588, 2: 600, 3: 600, 4: 299, 5: 20000, 6: 117, 7: 160} and spans_cover(spark, rows) == want


def local_score(x, y):
    best, row = 0, [0] * (len(y) + 1)
    for a in x:
        old, row = row, [0] * (len(y) + 1)
        for j, b in enumerate(y):
            row[j + 1] = max(0, old[j] + (1 if a == b else -1), old[j + 1] - 1, row[j] - 1)
            best = max(best, row[j + 1])
    return best


def test_smith_waterman_equals_plain_dp():
    rng = np.random.default_rng(3)
    for _ in range(60):
        x, y = rng.integers(0, 4, rng.integers(1, 12)).astype(np.uint64), rng.integers(0, 4, rng.integers(1, 30)).astype(np.uint64)
        score, equal, a, b = decontaminate.smith_waterman(x, y)
        assert score == local_score(x, y) and equal <= len(x) and 0 <= a <= b <= len(y)


def test_contaminated(spark):
    items = [(1, text(40, 21)), (2, text(30, 22)), (3, "too short"), (4, None), (5, "")]
    rows = [(i, text(100, 700 + i)) for i in range(10)]
    rows += [(20, f"{text(50, 1)} {items[0][1].upper()}, {text(20, 2)}"), (21, f"{text(9, 3)} {edited(items[0][1], 4, 1)}"), (22, " ".join(items[0][1].split()[:20])),
             (23, f"{text(5, 6)}\n{items[1][1]} {items[0][1]}"), (24, None), (25, "it is Too, short."), (20, f"{items[0][1]}")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, round(r.similarity, 2)) for r in decontaminate.contaminated(docs_of(spark, rows), benchmark).collect())
    assert got == [(20, 1, 1.0), (20, 1, 1.0), (21, 1, 0.9), (23, 1, 1.0), (23, 2, 1.0), (25, 3, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.without_contaminated(docs_of(spark, rows), benchmark).collect()) == [*range(10), 22, 24]
    assert decontaminate.contaminated(docs_of(spark, rows), benchmark.where("false")).count() == 0
    assert decontaminate.contaminated(docs_of(spark, []), benchmark).count() == 0


def test_contaminated_by_evenly_spread_edits(spark):
    def spread(t, places):
        return " ".join("EDIT%d" % i if i in places else w for i, w in enumerate(t.split()))
    items = [(1, text(9, 31)), (2, text(14, 32)), (3, text(40, 33)), (4, text(20, 34)), (5, text(10, 35)), (6, text(5, 36))]
    edits = {1: [4], 2: [4, 9], 3: range(4, 40, 5), 4: [4, 9, 14, 19], 5: [3, 6], 6: [2]}
    rows = [(i, f"{text(30, 60 + i)} {spread(t, edits[i])} {text(30, 70 + i)}") for i, t in items]
    rows += [(100 + i, f"{text(30, 800 + i)} {items[2][1]}") for i in range(120)]  # every n-gram of item 3 is frequent
    rows += [(300, f"{text(30, 80)} {spread(items[2][1], [*range(4, 40, 5), 0])}")]
    got = sorted((r.doc_id, r.item_id, round(r.similarity, 2)) for r in decontaminate.contaminated(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect())
    assert got == [(1, 1, 0.89), (2, 2, 0.86), (3, 3, 0.8), (4, 4, 0.8), (5, 5, 0.8), (6, 6, 0.8)] + [(100 + i, 3, 1.0) for i in range(120)]


def base_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    repeated = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated)


def test_line_quality(spark):
    menu = "Home | About   us"
    rows = [(i, f"{menu}\n{text(40, i)}\n{text(15, 3000 + i)}", "h") for i in range(40)]
    rows += [(100 + i, f"home | ABOUT us\n{menu}\n{'menu words here ' * 4}\n" + (text(30, 77) if i else ""), "h") for i in range(2)]
    rows += [(200, None, None), (201, "", "h"), (202, "a\nb\na\n \n\na é" + " x y z" * 30, "q"), (203, text(30, 5) + " " + text(30, 5), "q"), (0, rows[0][1], "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_frequency.line_quality(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows:
        r = by[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_counts(t or ""), i
    assert all(by[i].n_removed_words == 4 and by[i].kept and by[i].removed_lines == [0] for i in range(40))
    assert by[101].removed_lines == [0, 1] and not by[100].kept and not by[200].kept and by[203].base_failed
    cleaned = df.join(line_frequency.line_quality(df).where("doc_id = 3").select("doc_id", "removed_lines"), "doc_id").select(line_frequency.without_lines(F.col("text"), F.col("removed_lines")).alias("text")).first()
    assert cleaned.text == rows[3][1].removeprefix(menu + "\n")
    assert line_frequency.line_quality(df.where("false")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no</p>";</script></head><body><header>Site name</header>
<nav><ul><li><a href=/a>Home</a></li></ul></nav><div class="cookie-notice">We use cookies on this site for you</div>
<article><h1>A &amp; B</h1><p>First paragraph of <b>bold</b>\n text,&nbsp;with words enough to stay here.<br><p>Second one, short.</p>
<div class='ad'>Buy now this great thing</div><p title="a > b">Third &lt;tag&gt; paragraph</p></article>
<section id="comments"><p>I think this article is wrong about nearly everything it says</p></section>
<aside><p>Related reading of many words that is not the article at all</p></aside><form>Name <input> <button>Send</button></form><footer>&copy; x"""


def test_html_blocks(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p>cut off <b"), (None, "u", PAGE), (5, "u", "plain words only"), (6, "u", "<article><p>" + "w " * 30 + "</p><p>a &am b <i")]
    got = {r.page_id: r for r in html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    want = "A & B\n\nFirst paragraph of bold text, with words enough to stay here.\n\nSecond one, short.\n\nThird <tag> paragraph"
    assert got[1].text == want == got[None].text and got[1].n_chars == len(want)
    assert got[2].text == "" and got[3].n_chars == 0 and got[6].text == "w " * 29 + "w\n\na &am b"
    x, y = html_blocks.training_table()
    assert ((html_blocks.predict(html_blocks.grow(x, y), x) >= 0.5) == y).mean() > 0.97


@pytest.mark.parametrize("page, want", [
    ("<p>a</p><svg-icon></svg-icon><p>rest</p>", ["a", "rest"]),
    ("<p>a<title-bar>b</title-bar><select-menu><template-x>c", ["a", "b", "c"]),
    ("<p>a <svg width='1'/> b <math/> c</p><svg><g/><text>no</text></svg><p>d", ["a b c", "d"]),
    ("<p>a <select><option>x</p><p>b</p><object data=u><p>c</p><select><option>no</select>d<iframe src=u>", ["a", "x", "b", "c", "d"]),
    ("<object><object>no</object>no</object><p>a<noscript><p>b", ["a", "b"]),
    ("<!-- <svg> --><svg><!-- </svg> -->no</svg><script>'<svg>'</script>a", ["a"]),
    ("<html><head><title>no</title><meta charset=u><link href=u><p>a</p><p>b", ["a", "b"]),
    ("<head><title>no</title>\n<script>no</script><noscript>no</noscript> a b", ["a b"]),
    ("<head><title>no</title><style>no</style></head><body>a<textarea>no", ["a"]),
])
def test_html_of_unclosed_and_custom_elements(page, want):
    assert [b.text for b in html_blocks.blocks(page)] == want


def test_toxicity(spark):
    r = random.Random(2)
    bad = ["vile" + x for x in ("ling", "some", "ness", "dom")]
    rows, labels = [], []
    for i in range(900):
        w = r.choices(WORDS, k=60)
        toxic = i % 8 == 0
        if toxic:
            w[r.randrange(60)] = r.choice(bad)
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "vileling")]
    docs, lab = docs_of(spark, rows), spark.createDataFrame(labels + [(7, None)], "doc_id long, toxic int")
    model = toxicity_pu.train(docs, lab)
    got = {x.doc_id: x for x in toxicity_pu.score(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= x.score <= 1 for x in got.values()) and got[5000].predicted == 0
    right = [got[i].predicted == (i % 8 == 0) for i in range(900) if got[i].held_out]
    assert np.mean(right) > 0.95 and 100 < len(right) < 260
    stay = toxicity_pu.without_toxic(docs, model)
    assert stay.columns == docs.columns and stay.count() == sum(x.predicted == 0 for x in got.values())
    assert toxicity_pu.score(docs, toxicity_pu.train(docs, lab.where("false"))).where("predicted = 1").count() == 0
    # The held-out fold's labels are never read: turning them round changes no score.
    turned = lab.withColumn("toxic", (toxicity_pu.held_out("doc_id") != (lab.toxic == 1)).cast("int"))
    assert {x.doc_id: x.score for x in toxicity_pu.score(docs, toxicity_pu.train(docs, turned)).collect()} == {k: v.score for k, v in got.items()}


def brute_tokens(scores, token):
    unknown = min(scores.values()) - token_counts.BYTE_PENALTY
    ways = [(0.0, 0)] + [(-1e18, 0)] * len(token)
    for end in range(1, len(token) + 1):
        for start in range(end):
            piece = token[start:end]
            n = len(piece.encode())
            for gain, k in ([(scores[piece], 1)] if piece in scores else []) + ([(n * unknown, n)] if len(piece) == 1 and piece not in scores else []):
                ways[end] = max(ways[end], (ways[start][0] + gain, ways[start][1] - k))
    return -ways[-1][1]


def test_token_counts(spark):
    path = tokenizer("piece_bpe_32k.model")
    scores = token_counts.unigram_scores(path)
    rows = [(1, "the theory  of\nthe thesis"), (2, None), (3, " \t"), (4, "naïve 漢字 \U0001f600x unbelievable"), (5, "ab" * 700), (1, "the theory")]
    got = sorted((r.doc_id, r.n_words, r.n_bytes, r.n_tokens) for r in token_counts.token_counts(docs_of(spark, rows), path).collect())
    split = lambda t: (t or "").encode().split()
    assert got == sorted((i, len(split(t)), len((t or "").encode()), sum(brute_tokens(scores, "▁" + w.decode()) for w in split(t))) for i, t in rows)


def test_pipeline(spark):
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        out = P.persisted(stage(spark, kept[-1], sf), name)
        assert out.columns == docs.columns and 0 < out.count() <= kept[-1].count()
        kept.append(out)
    verdict = components([(r.doc_id, r.text) for r in kept[1].collect()])
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(x[0] for x in verdict if x[3])
    pieces = P.STAGES[-1][1](spark, kept[-1], sf).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept[-1].collect()}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables")
@pytest.mark.parametrize("table", ["documents", "pages"])
def test_registered_queries_return_every_row(spark, table):
    from repsmith.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    names = ("op6_html_blocks", "op1_arc_to_warc") if table == "pages" else ("op2_bounded_ring", "op7_minhash_stars", "op8_nnpu_toxicity", "op9_trie_token_counts")
    n = spark.read.parquet(f"{sf}/{table}.parquet").count()
    for name in names:
        assert QUERIES[name](spark, sf).count() == n, name


@pytest.mark.parametrize("name", ["op1_arc_to_warc", "op5_line_frequency", "op7_minhash_stars"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    from repsmith.llm.queries import ORACLE_SQL, QUERIES
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    cur = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(map(str, cur.fetchall())) == sorted(str(tuple(r)) for r in QUERIES[name](spark, sf).select(*columns).collect())


PARAGRAPHS = ["".join(f"<p>{' '.join(f'w{i}x{j}' for j in range(40))}.</p>" for i in range(4))]


def page_text(spark, body):
    return html_blocks.extract(spark.createDataFrame([(1, "u", body)], "page_id long, url string, html string")).first().text


def test_articles_under_everyday_class_names(spark):
    article = "<h1>A heading of some words here</h1>" + PARAGRAPHS[0]
    plain = page_text(spark, f"<html><body><article>{article}</article></body></html>")
    assert plain.count("w3x39") == 1 and len(plain) > 900
    for wrapped in ('<div class="content has-sidebar"><article>{}</article></div>', '<article class="post comment-open">{}</article>', '<main class="site-main with-navigation">{}</main>',
                    '<article class="post tag-search">{}</article>', '<div class="page social-science"><article>{}</article></div>', '<body class="no-sidebar category-related"><article>{}</article></body>'):
        assert page_text(spark, "<html><body>" + wrapped.format(article) + "</body></html>") == plain, wrapped


@pytest.mark.parametrize("name", ["nav", "site-footer", "widget-title", "sidebar-left", "navBar", "share-buttons", "cookie-notice", "comment-list", "ad", "ad-slot-3", "main-navigation", "post-comments", "related"])
def test_furniture_names_stay_marks(name):
    assert html_blocks._marked(f' class="x {name}"', "div")


@pytest.mark.parametrize("name", ["has-sidebar", "comment-open", "social-science", "tag-search", "no-sidebar", "with-navigation", "searching", "is-sponsored", "notice-of-motion"])
def test_other_names_are_none(name):
    assert not html_blocks._marked(f' class="{name}"', "div") and not html_blocks._marked(f" id={name}", "article")


def test_stray_quotes_and_signs_swallow_nothing():
    page = "<article><p data-x=it's>first words</p><p>middle words</p><p>don't stop</p><p title='a > b'>quoted</p><p title=\"it's\">both</p> I like you <3"
    assert [b.text for b in html_blocks.blocks(page)] == ["first words", "middle words", "don't stop", "quoted", "both", "I like you <3"]
    for end, kept in (("<", "x <"), ("</", "x </"), ("<b", "x"), ("<!-", "x"), ("</di", "x"), ("< b", "x < b"), ("<p class='a", "x")):
        assert " ".join(b.text for b in html_blocks.blocks("<p>x " + end)) == kept, end
