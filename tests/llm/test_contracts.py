"""The queries' results against brute force in plain Python, on the smallest tables and on edge rows."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest

from quire.llm import html_text, line_dedup, media, mixing, near_dedup, packing, pii, quality_model, quality_rules, suffix_dedup

WS = " \t\n\x0b\x0c\r"
LAST = 2**63 - 1


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def low(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def counted(rows):
    return sorted(rows, key=repr)


# --- line dedup -------------------------------------------------------------------------------


def brute_lines(rows):
    first = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = low(x.strip(WS))
            if len(k) >= 10:
                first[k] = min(first.get(k, LAST), LAST if i is None else i)
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        keep = [x for x in parts if first.get(low(x.strip(WS)), LAST) >= (LAST if i is None else i)]
        out.append((i, len(parts), len(parts) - len(keep), "\n".join(keep)))
    return out


@pytest.mark.parametrize("batches", [1, 3, 6])
def test_line_dedup(spark, docs, edge, empty, batches):
    for d in (docs, edge) if batches == 3 else (edge,):
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.line_dedup(spark, d, batches=batches).collect()]
        assert counted(got) == counted(brute_lines(texts(d)))
    assert line_dedup.line_dedup(spark, empty, batches=batches).count() == 0


def test_line_index_takes_batch_after_batch(spark, docs):
    """Five batches in order of doc_id, compacted on the way, give what one batch of all gives; no table is left."""
    rows = sorted(texts(docs))
    with line_dedup.LineIndex(spark) as index:
        got = []
        for k in range(5):
            part = rows[k * len(rows) // 5 : (k + 1) * len(rows) // 5]
            got += [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in index.add(spark.createDataFrame(part, "doc_id long, text string")).collect()]
        assert index.runs.compactions == 3 and [len(level) for level in index.runs.levels] == [1, 0, 1]
    assert counted(got) == counted(brute_lines(rows))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("quire_run_")]



# --- quality rules ------------------------------------------------------------------------------


def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = {}
    for i in range(len(w) - 4):
        wins.setdefault(tuple(w[i : i + 5]), []).append(i)
    hit = {i + k for at in wins.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in t.split("\n") if x.strip(WS)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


def test_quality_rules(spark, docs, edge, empty):
    for d in (docs, edge):
        got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.quality_rules(spark, d).collect()]
        assert counted(got) == counted([(i, *brute_quality(t)) for i, t in texts(d)])
        kept = quality_rules.quality_filter(spark, d)
        assert kept.columns == d.columns
        assert counted([r.doc_id for r in kept.collect()]) == counted([r.doc_id for r in quality_rules.quality_rules(spark, d).where("kept").collect()])
    assert quality_rules.quality_rules(spark, empty).count() == 0


# --- page text ------------------------------------------------------------------------------------


def kinds(page):
    """(article's blocks, other blocks, marked blocks)."""
    found = html_text.blocks(page)
    return tuple([t for k, t in found if k == kind] for kind in (html_text.ARTICLE, html_text.OTHER, html_text.MARKED))


def test_page_blocks():
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><header>H</header><div class="cookieBanner">c</div><main><h1>A &amp; B</h1><p>one <b>two</b>three<p>four<br>five'
        '<div class="ad-slot">x</div><form>f</form><aside>s</aside><section id="comments"><article>mine</article></section></main><p>tail</p><footer>&copy; F</footer>'
    )
    assert kinds(page) == (["A & B", "one twothree", "four", "five"], ["tail"], ["H", "c", "x", "f", "s", "mine", "© F"])
    assert kinds("a < b&nbsp;c <script>'</p>'</script>d<a href=\"x") == ([], ["a < b c d"], [])
    assert html_text.blocks("") == []
    assert html_text.host_of("https://u@A.b:8/c?d") == "a.b:8" and html_text.host_of(None) == ""


@pytest.mark.parametrize(("page", "article"), [
    ('<div class="layout has-sidebar"><article>text</article></div>', ["text"]),
    ('<main><div class="comments-open post">text</div></main>', ["text"]),
    ('<main><section id="related-work">text</section></main>', ["text"]),
    ('<main><h2 id="discussion">text</h2></main>', ["text"]),
    ('<main><p title="once hidden now shown">text</p><p hidden>gone</p></main>', ["text"]),
    ('<form id="f"><main>text</main></form>', ["text"]),
    ('<article>text<div class="post-comments"><article>said</article></div></article>', ["text"]),
    ('<article>text</article><ol class="commentlist"><li><article class="comment">said</article></ol>', ["text"]),
    ('<article>one<p>two <span style="display: none">gone</span>three</article>', ["one", "two", "three"]),
])
def test_marks_leave_the_article_alone(page, article):
    assert kinds(page)[0] == article


def brute_pages(rows):
    """(page_id, text): runs by dictionaries over a host's distinct pages."""
    parsed = [(i, html_text.host_of(u), html_text.blocks(h or "")) for i, u, h in rows]
    hosts = {}
    for i, host, page in parsed:
        hosts.setdefault(host, {}).setdefault(tuple(page), []).append(LAST if i is None else i)
    out = []

    def runs(page):
        words = [(w, k) for k, (_, t) in enumerate(page) for w in t.split(" ")]
        return [(a, tuple(low(w) for w, _ in words[a : a + 8]), [k for _, k in words[a : a + 8]]) for a in range(len(words) - 7)], [k for _, k in words]

    for i, host, page in parsed:
        own = hosts[host]
        article = any(k == 0 for k, _ in page)
        kind = 0 if article else 1
        anywhere, outer = {}, {}
        for n, other in enumerate(own):
            for _, r, of in runs(other)[0]:
                anywhere.setdefault(r, set()).add(n)
                if other[of[0]][0] and other[of[-1]][0]:
                    outer.setdefault(r, set()).add(n)
        found, of = runs(tuple(page))
        bad = [(a, ks) for a, r, ks in found if (len(anywhere[r]) >= max(3, len(own) / 2) if article else len(outer.get(r, ())) >= 3)]
        any_ = {a + k for a, _ in bad for k in range(8)}
        within = {a + k for a, ks in bad if ks[0] == ks[-1] for k in range(8)}
        kept, cut, total, at = [], 0, 0, 0
        for b, (k, t) in enumerate(page):
            words = t.split(" ")
            at0, at = at, at + len(words)
            if k != kind:
                continue
            gone = any_ if all(x in any_ for x in range(at0, at)) else within
            left = [w for x, w in enumerate(words, at0) if x not in gone]
            total, cut = total + len(words), cut + len(words) - len(left)
            kept += [" ".join(left)] if left else []
        text = " ".join(t for k, t in page if k == kind) if article and 2 * cut > total else " ".join(kept)
        copies = own[tuple(page)]
        out.append((i, "" if not article and len(copies) >= 3 and min(copies) != (LAST if i is None else i) else text))
    return out


def made_pages():
    """Hosts with and without articles, with notices on some or most pages, inside and outside articles, and copies."""
    rng = random.Random(8)
    say = lambda n: " ".join(rng.choice("abcdefghijkl") + rng.choice("xyz") for _ in range(n))
    notices = [say(14) for _ in range(4)]
    rows = []
    for i in range(160):
        host, bare = f"h{i % 5}.x", i % 3 == 0
        parts = [f"<nav>{notices[0]}</nav>"] + [f"<p>{say(rng.randrange(1, 30))}</p>" for _ in range(3)]
        parts += [f"<p>{rng.choice(notices)} {say(3)}</p>"] if rng.random() < 0.5 else []
        parts += [f"<div>{notices[1]}</div>"] if i % 5 < 2 else []
        rng.shuffle(parts)
        rows.append((i, f"http://{host}/{i}", "".join(parts) if bare else f"<div class='menu'>{notices[2]}</div><article>{''.join(parts)}</article>"))
    rows += [(200 + k, "http://h0.x/c", rows[0][2]) for k in range(3)] + [(300 + k, "http://h1.x/c", rows[1][2]) for k in range(5)]
    return rows + [(None, None, None), (9, None, ""), (400, "http://h2.x", "<article></article>"), (401, "http://h2.x", "<article>" + say(20_000) + "</article>")]


def test_main_text_against_brute_force(spark):
    rows = made_pages()
    d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for c in ("host", "kinds", "blocks", "content", "line", "copies", "fresh", "gone"):
        d = d.withColumn(c, d["url"])
    assert counted((r.page_id, r.text) for r in html_text.main_text(spark, d).collect()) == counted(brute_pages(rows))


def test_suffix_boilerplate(spark):
    import numpy as np

    rng = random.Random(1)
    streams = [[rng.randrange(6) for _ in range(rng.randrange(40))] for p in range(30)]
    flat = np.array([x for s in streams for x in s], np.int64)
    owner = np.repeat(np.arange(30), [len(s) for s in streams])
    seen = {}
    for p, s in enumerate(streams):
        for k in range(len(s) - 3):
            seen.setdefault(tuple(s[k : k + 4]), set()).add(p)
    want = [any(a <= k < a + 4 and len(seen[tuple(s[a : a + 4])]) >= 3 for a in range(len(s) - 3)) for s in streams for k in range(len(s))]
    assert html_text.covered(flat, owner, 4, 3).tolist() == want
    menu = "home about contact imprint privacy terms jobs press"
    rows = [(i, f"http://h.x/{i}", f"<div>{menu}</div><div>page {i} tells of thing{i}</div>") for i in range(5)] + [(9, None, None), (9, None, None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = counted((r.page_id, r.text) for r in html_text.main_text(spark, d).collect())
    assert got == counted([(i, f"page {i} tells of thing{i}") for i in range(5)] + [(9, "")] * 2)
    assert html_text.main_text(spark, d.where("false")).count() == 0


def test_boilerplate_of_few_pages_of_a_large_host(spark):
    """A notice on 4 pages of a host of 3,000, which is dealt to 12 shards."""
    notice = "members of the rowing club meet on friday evenings only"
    page = lambda i: " ".join(f"own{i}word{k}" for k in range(12))
    rows = [(i, f"http://h.x/{i}", f"<div>{page(i)}</div>" + f"<div>{notice}</div>" * (i % 750 == 0)) for i in range(3_000)]
    got = html_text.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {i: page(i) for i in range(3_000)}


def test_unique_runs_of_a_block_stay(spark):
    """A block's covered runs go and its own words stay, however much of it is covered; one of equal pages keeps its text."""
    notice = " ".join(f"notice{k}" for k in range(20))
    own = lambda i: f"thing{i} is told on page {i}"
    long = lambda i: " ".join(f"page{i}word{k}" for k in range(60))
    rows = [(i, f"http://h.x/{i}", f"<div>{notice} {own(i)}</div>") for i in range(4)] + [(i, f"http://h.x/{i}", f"<div>{long(i)} {notice}</div>") for i in range(4, 8)]
    rows += [(i, f"http://h.x/{i}", f"<div>{long(99)}</div>") for i in (12, 10, 11)] + [(i, f"http://h.x/{i}", f"<div>{long(98)}</div>") for i in (13, 14)]
    got = {r.page_id: r.text for r in html_text.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: own(i) for i in range(4)} | {i: long(i) for i in range(4, 8)} | {10: long(99), 11: "", 12: "", 13: long(98), 14: long(98)}


# --- media ------------------------------------------------------------------------------------------


def test_media(spark, docs, edge, empty):
    for d in (docs, edge):
        got = media.media_columns(spark, d, shard_bytes=20_000).collect()
        want = []
        for i, t in texts(d):
            b = (t or "").encode()
            p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
            want.append((i, len(b), len(p), sha(p), zlib.crc32(p[-64:])))
        assert counted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got) == counted(want)
        by = {}
        for r in got:
            by.setdefault(r.digest, set()).add((r.media_bytes, r.media_sha256, r.feature, r.width, r.height))
        assert all(len(v) == 1 for v in by.values())
    r = got[0]
    assert sha(media.read_member(r.shard, f"{r.digest}.png")) == r.media_sha256
    assert media.media_columns(spark, empty).count() == 0
    assert media.decode(media.encode(bytes(range(256)))) == bytes(range(256))


# --- packing -----------------------------------------------------------------------------------------


def test_packing(spark, docs, edge, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary())
    added = spark.createDataFrame([(1, "one<|endoftext|>two"), (None, "<|endoftext|>"), (2, " <|endoftext|>\n" * 3), (3, "<|endoftext |>")], "doc_id long, text string")
    for d in (docs, edge, added):
        got = packing.pack_documents(spark, d).collect()
        want = []
        for i, text in texts(d):
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
            want += [(i, at, len(ids[at : at + 2048]), zlib.crc32(struct.pack(f"<{len(ids[at : at + 2048])}I", *ids[at : at + 2048])), len(ids)) for at in range(0, len(ids), 2048)]
        assert counted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == counted(want)
        bins = {}
        for r in got:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for o, n in sorted(b):
                assert o == at
                at += n
            assert at <= 2048
        assert 2048 * len(bins) <= 1.05 * sum(n for b in bins.values() for _, n in b) + 2048
    assert packing.pack_documents(spark, empty).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_shortest_pack_first(seed):
    rng = random.Random(seed)
    h = {rng.randrange(1, 65): rng.randrange(1, 400) for _ in range(40)}
    p = packing.shortest_pack_first(h, 64)
    back = {}
    for n, lengths in p:
        assert sum(lengths) <= 64
        for x in lengths:
            back[x] = back.get(x, 0) + n
    assert back == h


# --- near duplicates -----------------------------------------------------------------------------------


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(LAST if i is None else i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, u in sets[:a]:
            if s and u and 100 * len(s & u) >= 75 * len(s | u):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    own = lambda i: None if i == LAST else i
    return [(own(i), len(s), own(top(i)), top(i) == i) for i, s in sets]


def variants():
    """Chains of copies with more and more words replaced: links at every distance around the threshold."""
    rng = random.Random(4)
    rows, word = [], lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(120)]
    for i in range(150):
        w = list(base if i % 3 else rows and rng.choice(rows)[1].split() or base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = word()
        rows.append((1000 - i, " ".join(w)))
    return rows


def test_near_duplicates(spark, docs, edge, empty):
    chain = spark.createDataFrame(variants(), "doc_id long, text string")
    for d in (docs, edge, chain):
        got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark, d).collect()]
        assert counted(got) == counted(brute_components(texts(d)))
    assert near_dedup.near_duplicates(spark, empty).count() == 0
    assert near_dedup.keep_one(spark, edge).columns == edge.columns


def crowd(n=2500, linked=12):
    """A text, copies of it that are just linked to it and a crowd before them that just isn't; no two others are linked."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]

    def copy(k, run):  # run words replaced: run + 4 of the 116 shingles
        at = rng.randrange(4, 116 - run)
        return " ".join([*base[:at], *(f"x{k}y{i}" for i in range(run)), *base[at + run :]])

    return [*((k, copy(k, 13)) for k in range(n)), (50_000, " ".join(base)), *((60_000 + k, copy(60_000 + k, 12)) for k in range(linked))]


def test_near_duplicates_in_a_crowd(spark):
    rows = crowd()
    own, jaccard = shingles(rows[2500][1]), lambda a, b: len(a & b) / len(a | b)
    assert all((jaccard(own, shingles(t)) >= 0.75) == (i >= 50_000) for i, t in rows)
    assert max(jaccard(shingles(a), shingles(b)) for k, (_, a) in enumerate(rows[:200]) for _, b in rows[:k]) < 0.75
    found = near_dedup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: min(i, 50_000) for i, _ in rows}


def test_near_duplicates_bitmaps(monkeypatch):
    """No pair that is similar enough is lost, whatever the bitmaps' widths, and blocks that meet are what all pairs are."""
    rng = np.random.default_rng(5)
    sets = []
    for n in (1, 3, 60, 64, 65, 100, 128, 129, 1000, 20_000):
        base = rng.integers(0, 2**64, n, np.uint64)
        for part in (0.7, 0.74, 0.75, 0.76, 0.9, 1.0):
            sets.append(np.unique(base[: max(1, round(n * part))]))
            swapped = rng.integers(0, 2**64, max(1, round(n * (1 - part) / 2)), np.uint64)
            sets.append(np.unique(np.concatenate([base[len(swapped) :], swapped])))
    of, size = np.arange(len(sets)), np.array([len(s) for s in sets])
    want = {(i, j) for i in of.tolist() for j in range(i) if near_dedup.similar(sets[i], sets[j])}
    for most in (near_dedup.MOST_BITS, 1024):  # a coarse bitmap gives more pairs, never fewer
        monkeypatch.setattr(near_dedup, "MOST_BITS", most)
        maps = [near_dedup._bitmap(s) for s in sets]
        got = {(max(i, j), min(i, j)) for x, y in near_dedup._close(of, size, maps, of, of) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
        assert want <= got and len(want) > 100
        halves = [(max(i, j), min(i, j)) for x, y in near_dedup._close(of // 3, size, maps, of[::2], of[1::2]) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
        assert set(halves) == {(i, j) for i, j in got if (i - j) % 2 and i // 3 != j // 3} and len(set(halves)) == len(halves)


def test_near_duplicates_with_small_blocks(spark, monkeypatch):
    """Buckets cut into many blocks, with components that fill blocks of their own, lose no link."""
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    monkeypatch.setattr(near_dedup, "MOST_BLOCKS", 5)
    rows = [*variants(), *crowd(60, 4)]
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert counted(got) == counted(brute_components(rows))


# --- repeated strings -----------------------------------------------------------------------------------


def brute_repeats(rows):
    first = {}
    data = sorted(((LAST if i is None else i, i, (t or "").encode()) for i, t in rows), key=lambda x: x[0])
    for k, _, b in data:
        for j in range(len(b) - 49):
            first.setdefault(b[j : j + 50], k)
    out = []
    for k, i, b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j : j + 50]] < k:
                gone[j : j + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def passages():
    """Texts cut from a few strings, so that windows repeat with all neighbours; one string in most texts."""
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    pool = [make(rng.randrange(20, 160)) for _ in range(12)]
    return [(i, "".join(rng.choice(pool) if rng.random() < 0.6 else make(rng.randrange(60)) for _ in range(6)) + (pool[0] if i % 4 else "")) for i in range(250)]


def test_suffix_dedup(spark, docs, edge, empty):
    made = spark.createDataFrame(passages(), "doc_id long, text string")
    for d in (edge, made, docs.limit(120)):
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(spark, d).collect()]
        assert counted(got) == counted(brute_repeats(texts(d)))
    assert suffix_dedup.remove_repeats(spark, empty).count() == 0


def test_suffix_dedup_of_many_rows_of_one_id(spark):
    """Rows of one id and of none, a text of one line repeated that another shares, a hot context beside many others."""
    line = "this line of more than fifty characters stands here again and again\n"
    rows = [(7, f"row {i} of the document with number seven, which has as many rows as that, {i % 11}") for i in range(600)]
    rows += [(None, f"a row without any id, but with text that others of its kind have as well {i % 7}") for i in range(300)]
    rows += [(3, line * 40 + "the end"), (5, "a start" + line * 25), (6, line), (8, line[:55])]
    rows += [(1000 + i, f"{i * 7919 % 10007} and then the passage that stands in all of these texts {i * 104729 % 10007}") for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for part in (8, suffix_dedup.PART):
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(spark, d, part=part).collect()]
        assert counted(got) == counted(brute_repeats(texts(d)))


def test_deep_shallow():
    import numpy as np

    rng = random.Random(3)
    for _ in range(20):
        raw = bytes(rng.choice(b"ab") for _ in range(rng.randrange(60, 600))) * 2
        starts = np.array(rng.sample(range(len(raw) - 50), min(200, len(raw) - 50)))
        order, same = suffix_dedup.deep_shallow(np.frombuffer(raw, np.uint8), starts)
        keys = [raw[s : s + 50] for s in starts[order]]
        assert keys == sorted(keys) and sorted(order) == list(range(len(starts)))
        assert [keys.index(k) for k in keys] == same.tolist()


# --- personal data ---------------------------------------------------------------------------------------


def test_pseudonyms(spark, edge, empty):
    rows = [(1, "a.b@mail.org 4539 1488 0343 6467 2024-02-29"), (2, "A.B@mail.org 4539148803436467, 30.02.2001 4539148803436468 29/02/2024"), (3, None), (4, "+1 (017) 555-7713 10.0.0.255 token = \"0123456789abcdef\""), (5, "plain text, 3 of 4"), (6, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymize(d, key="k").collect()}
    digits = lambda s: re.sub(r"\D", "", s)
    one, two = got[1].text.split(" "), got[2].text.split(" ")
    assert one[0] == two[0] and "mail.org" not in one[0]
    card = " ".join(one[1:5])
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", card) and digits(card) == digits(two[1]) != "4539148803436467"
    total = sum(sum(divmod(int(c) * (2 if k % 2 else 1), 10)) for k, c in enumerate(reversed(digits(card))))
    assert total % 10 == 0
    assert two[2:4] == ["30.02.2001", "4539148803436468"]
    y, m, day = one[5].split("-")
    assert two[4] == f"{day}/{m}/{y}" != "29/02/2024"
    assert got[3].text is None and got[5].text == rows[4][1] and got[6].text == "" and got[5].n_found == 0
    assert got[4].text.startswith("+1 (") and "555-7713" not in got[4].text and "10.0.0.255" not in got[4].text and "0123456789abcdef" not in got[4].text
    assert (got[1].n_email, got[1].n_card, got[1].n_date, got[4].n_phone, got[4].n_ip, got[4].n_secret) == (1,) * 6
    assert pii.pseudonymize(edge, key="k").count() == edge.count() and pii.pseudonymize(empty, key="k").count() == 0
    other = pii.pseudonymize(d, key="other").where("doc_id = 1").first().text
    assert other != got[1].text


class PlainFeistel:
    """The permutations in plain Python, from their description: ten rounds over halves, keyed by SHA-256."""

    def __init__(self, key):
        self.key = key

    def digest(self, *parts):
        return int(hashlib.sha256(":".join(map(str, (self.key, *parts))).encode()).hexdigest()[:15], 16)

    def digits(self, d, tweak):
        a, b = d[: len(d) // 2], d[len(d) // 2 :]
        for i in range(10):
            m = 10 ** len(a)
            a, b = b, str((int(a or 0) + self.digest(tweak, i, len(d), b) % m) % m).zfill(len(a))
        return a + b

    def bits(self, v, tweak, left, right):
        a, b = v >> right, v & ((1 << right) - 1)
        for i in range(10):
            wide = 1 << (right if i % 2 else left)
            a, b = b, (a + self.digest(tweak, i, b) % wide) % wide
        return (a << right) + b

    def fill(self, shape, digits):
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in shape)

    def card(self, m):
        d = re.sub(r"\D", "", m)
        total = lambda x: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(x)))
        if total(d) % 10:
            return m
        body = self.digits(d[:-1], "card")
        return self.fill(m, body + str(-total(body + "0") % 10))

    def ssn(self, m):
        d = self.digits(m.replace("-", ""), "ssn")
        while d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000":
            d = self.digits(d, "ssn")
        return self.fill(m, d)

    def ip(self, m):
        a, b, c, d = map(int, m.split("."))
        v = self.bits(((a * 256 + b) * 256 + c) * 256 + d, "ip", 16, 16)
        return ".".join(str(v >> s & 255) for s in (24, 16, 8, 0))

    def date(self, m):
        import datetime

        v = (datetime.date.fromisoformat(m) - datetime.date(1900, 1, 1)).days
        v = self.bits(v, "date", 8, 9)
        while v >= 73_049:
            v = self.bits(v, "date", 8, 9)
        return str(datetime.date(1900, 1, 1) + datetime.timedelta(v))

    def phone(self, m, code):
        d = re.sub(r"\D", "", m)
        return self.fill(m, d[:code] + self.digits(d[code:], "phone"))


def test_pseudonyms_against_plain_python(spark):
    rng = random.Random(6)
    p, rows, want = PlainFeistel("k"), [], []
    for i in range(300):
        ssn = f"{rng.randrange(1, 666):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10_000):04d}"
        ip, date = ".".join(str(rng.randrange(256)) for _ in range(4)), f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}"
        card = "".join(str(rng.randrange(10)) for _ in range(16))
        code, country = rng.choice([(1, "1"), (2, "49"), (3, "351"), (1, "7")])
        n = "".join(str(rng.randrange(10)) for _ in range(9))
        phone = rng.choice([f"+{country} {n[:3]} {n[3:6]} {n[6:]}", f"+{country}{n}", f"+{country}-{n[:3]}-{n[3:]}"])
        rows.append((i, f"a {ssn} b {ip} c {date} d {card} e {phone} f"))
        want.append((i, f"a {p.ssn(ssn)} b {p.ip(ip)} c {p.date(date)} d {p.card(card)} e {p.phone(phone, code)} f"))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("matches", "pseudonyms", "changed", "_m", "_n", "_c", "Matches_"):
        d = d.withColumn(c, d["text"])
    got = pii.pseudonymize(d, key="k")
    assert got.columns[:9] == d.columns
    assert counted((r.doc_id, r.text) for r in got.collect()) == counted(want)
    same = spark.createDataFrame([(1, "+1 415 555 7713"), (2, "+14155557713")], "doc_id long, text string")
    a, b = (re.sub(r"\D", "", r.text) for r in pii.pseudonymize(same, key="k").collect())
    assert a == b != "14155557713"


def test_feistel_permutes(spark):
    from pyspark.sql import functions as F

    d = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert d.select(pii.feistel_digits(F.col("d"), F.lit("k"), "t").alias("x")).distinct().count() == 1000


# --- classifier, mixing, pipeline ---------------------------------------------------------------------------


def test_quality_model(spark, docs, edge, empty, sf):
    import math

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    odd = labels.unionByName(labels.limit(5)).unionByName(labels.limit(3).selectExpr(*[f"null as {c}" if c != "doc_id" else "-7L as doc_id" for c in labels.columns]))
    model = quality_model.train(spark, docs, quality_model.graded(labels))
    ids, w, t = model
    assert 0 < len(ids) == len(w) <= quality_model.FEATURES and (t[1:] > t[:-1]).all()
    again = quality_model.train(spark, docs.unionByName(docs).repartition(7), quality_model.graded(odd))
    assert all((a == b).all() for a, b in zip(model, again, strict=True))
    weight = dict(zip(ids.tolist(), w.tolist(), strict=True))
    sigmoid = lambda z: 1 / (1 + math.exp(-max(-40, min(40, z))))
    for d in (docs, edge):
        want = []
        for i, text in texts(d):
            z = sum(weight.get(f, 0.0) for f in next(quality_model.features([(text or "").encode()])).tolist())
            above = [1 - sigmoid(x - z) for x in t]
            want.append((i, round(sum(above), 9), round(above[-1], 9), above[-1] >= quality_model.TAIL))
        got = quality_model.score(d, model).withColumn("kept", quality_model.F.col("tail_probability") >= quality_model.TAIL).collect()
        assert counted((r.doc_id, round(r.expected_grade, 9), round(r.tail_probability, 9), r.kept) for r in got) == counted(want)
    assert quality_model.quality_scores(spark, edge, labels).count() == edge.count()
    assert quality_model.quality_scores(spark, empty, labels.where("false")).count() == 0


def test_quality_model_on_held_out_ratings(spark, sf):
    """Fitted on the labels of even doc_ids, judged on the others."""
    big = "/root/testdata/sf0.1"
    d = spark.read.parquet(f"{big}/documents.parquet")
    grades = quality_model.graded(spark.read.parquet(f"{big}/labels.parquet")).where("grade is not null")
    model = quality_model.train(spark, d, grades.where("doc_id % 2 = 0"))
    rest = quality_model.score(d, model).join(grades.where("doc_id % 2 = 1"), "doc_id").toPandas()
    top = (rest["tail_probability"] >= quality_model.TAIL).groupby(rest["grade"]).mean()
    assert top[2] > 0.97 and top[1] < 0.05 and top[0] < 0.15


def test_raking():
    import pandas as pd

    rng = random.Random(2)
    cells = pd.DataFrame([(s, g, k, rng.randrange(1, 1000)) for s in "abc" for g in ("en", "de") for k in range(3)], columns=["source", "lang", "topic", "tokens"])
    want = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.6, "de": 0.4}}
    p = mixing.rake(cells, want, 0.3)
    for axis, shares in want.items():
        got = p.groupby(axis)["weight"].sum()
        assert all(abs(got[k] - v) < 1e-4 for k, v in shares.items())
    assert abs((p["probability"] * p["tokens"]).sum() - 0.3 * p["tokens"].sum()) < 1e-4 * p["tokens"].sum() and p["probability"].between(0, 1).all()
    assert mixing.rake(cells.iloc[:0], want, 0.3).empty


@pytest.mark.parametrize("hot", [1, 400])
def test_mixture_meets_targets_at_the_budget(hot):
    """One cell of source a is `hot` times the others' size, and one topic is very rare; most of the budget is kept all the same."""
    import pandas as pd

    rng = random.Random(3)
    cells = pd.DataFrame([(s, g, k, 1 if k == 3 else rng.randrange(200, 1000) * (hot if (s, g, k) == ("a", "en", 0) else 1)) for s in "abcd" for g in ("en", "de", "es") for k in range(4)], columns=["source", "lang", "topic", "tokens"])
    p = mixing.rake(cells, {}, mixing.BUDGET)
    kept, total = p["probability"] * p["tokens"], p["tokens"].sum()
    assert p["probability"].between(0, 1).all() and 0.95 * mixing.BUDGET * total < kept.sum() <= mixing.BUDGET * total * (1 + 1e-9)
    for axis in mixing.AXES:
        shares = p.groupby(axis)["tokens"].sum() / total
        want = mixing.tempered(shares)
        assert abs(want.sum() - 1) < 1e-9 and (want <= shares / mixing.BUDGET * (1 + 1e-9)).all()
        assert ((kept.groupby(p[axis]).sum() / kept.sum() - want).abs() < 2e-2).all()


def brute_mixture(rows, budget):
    """Cells to probabilities with dictionaries, for tempered targets; rows: (source, lang, topic, tokens)."""
    cells = {}
    for *key, n in rows:
        if n:
            cells[tuple(key)] = cells.get(tuple(key), 0) + n
    total = sum(cells.values())
    own = {c: n / total for c, n in cells.items()}
    kept = {c: v * budget for c, v in own.items()}
    goals = []
    for axis in range(3):
        have = {}
        for c, v in own.items():
            have[c[axis]] = have.get(c[axis], 0) + v
        full = set()
        while True:
            rest = sum(v**mixing.TEMPER for k, v in have.items() if k not in full)
            left = 1 - sum(have[k] / budget for k in full)
            want = {k: v / budget if k in full else v**mixing.TEMPER * left / rest for k, v in have.items()}
            over = {k for k in have if k not in full and want[k] > have[k] / budget * (1 + 1e-12)}
            if not over:
                break
            full |= over
        goals.append({k: v * budget for k, v in want.items()})
    for _ in range(mixing.RAKES):
        worst = 0
        for axis, goal in enumerate(goals):
            have = {}
            for c, v in kept.items():
                have[c[axis]] = have.get(c[axis], 0) + v
            worst = max(worst, *(abs(have[k] - g) / budget for k, g in goal.items()))
            kept = {c: min(own[c], v * goal[c[axis]] / have[c[axis]]) for c, v in kept.items()}
        if worst < mixing.CLOSE:
            break
    return {c: v / own[c] for c, v in kept.items()}


def test_topics_are_fitted_on_all_documents(spark):
    """Eight vocabularies, one of which only the documents beyond the first 4,000 by hash have."""
    from pyspark.sql import functions as F
    from pyspark.sql import Window

    ids = spark.range(4_600).select(F.col("id").alias("doc_id"), F.row_number().over(Window.orderBy(F.xxhash64("id"), "id")).alias("n"))
    kind = F.when(F.col("n") > 4_000, 7).otherwise(F.col("n") % 7)
    words = F.array([F.lit(" ".join(f"k{k}w{i}" for i in range(40))) for k in range(8)])
    d = ids.select("doc_id", words[kind.cast("int")].alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source")).repartition(5)
    found = {(r.kind, r.topic) for r in mixing.mix(spark, d).join(ids, "doc_id").select(kind.alias("kind"), "topic").distinct().collect()}
    assert len(found) == len({k for k, _ in found}) == len({t for _, t in found}) == 8


def test_mixing(spark, docs, edge, empty):
    a = {r.doc_id: r for r in mixing.mix(spark, docs).collect()}
    want = brute_mixture([(r.source, r.lang, r.topic, r.tokens) for r in a.values()], mixing.BUDGET)
    for r in a.values():
        p = want.get((r.source, r.lang, r.topic), 0.0) if r.tokens else 0.0
        assert abs(r.probability - p) < 1e-9 and r.kept == (r.draw < r.probability) and 0 <= r.draw < 1
    assert sum(r.tokens for r in a.values() if r.kept) > 0.6 * sum(r.tokens for r in a.values())
    b = {r.doc_id: r for r in mixing.mix(spark, docs, local_cells=0).collect()}
    assert a.keys() == b.keys() and all(abs(a[k].probability - b[k].probability) < 1e-9 and a[k].draw == b[k].draw for k in a)
    assert all(r.tokens == len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for r, t in ((a[i], t) for i, t in texts(docs)))
    e = mixing.mix(spark, edge)
    assert e.count() == edge.count() and e.where("kept and tokens = 0").count() == 0
    assert mixing.mix(spark, empty).count() == 0 and mixing.sample(spark, edge).columns == edge.columns


def test_pipeline_near_dedup_in_a_crowd(spark, sf):
    """Members of a bucket that aren't linked to its least one are still held against each other."""
    import corpus_pipeline as C

    near = dict(C.STAGES)["near dedup"]
    d = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in crowd()], "doc_id long, text string, lang string, source string, n_chars long")
    kept = near(spark, d, sf)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [*range(2500), 50_000]


def test_pipeline(spark, sf, docs):
    import corpus_pipeline as C

    d, before = docs, None
    for name, stage in C.STAGES[:-1]:
        before, d = d, stage(spark, d, sf).cache()
        assert d.columns == docs.columns
        old = dict(texts(before))
        new = dict(texts(d))
        assert new.keys() <= old.keys()
        if name == "quality rules":
            assert all(not brute_quality(t)[5] for t in new.values()) and len(new) < len(old)
        elif name == "line dedup":
            assert {i: x for i, _, _, x in brute_lines(list(old.items()))} == new
            assert all(r.n_chars == len(r.text) for r in d.collect())
        else:
            assert all(old[i] == t for i, t in new.items())
        if name == "near dedup":
            assert new.keys() == {i for i, _, _, k in brute_components(list(old.items())) if k}
    got = C.run(spark, sf)
    assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == set(new)
