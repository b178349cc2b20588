"""Corpus operators against libraries, brute force, SQL and held-out labels, with odd rows."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from compare import compare, connect

import __spark_entry__ as driver
import corpus_pipeline
from lendframe.llm import decontaminate, htmltext, langid, neighbours, ngramjoin, pieces, pii, quality, tokenfile, urlfilter

SF, SF1 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "\n\n", "a", "x " * 20_000, "y" * 20_000, "1 " * 8_000, "日本 語\u2028é́😀▁▁ \x00z", "<|endoftext|> A<s>b</s>", "dup text dup", "dup text dup"]


def vocabulary(name):
    return pytest.importorskip("public_tokenizers").path(name)


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def noise(seed, alphabet, n, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a null id, a repeated row, and columns named like those the operators make."""
    rows = [(i, t, "en", "s", 1, 0.5, "k") for i, t in enumerate(ODD)]
    rows += [(None, "no id here at all, none", None, None, None, None, None), rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, key string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF1}/documents.parquet")


def test_url_rules_match_sql(spark):
    con = connect(SF1)
    verdict, rows = compare(spark, con, SF1, "urls", driver.queries()["op2_url_filters"], driver.oracle_sql()["op2_url_filters"])
    assert verdict == "equal" and rows == 250


def test_url_cases(spark):
    cases = {
        "http://www.EXAMPLE.com/en/x": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://m.example.com/en/?q": ("m.example.com", "/en/", "example.com/en/", "block"),
        "http://example.com/fr": ("example.com", "/fr", "com/", "allow"),
        "x://a.net/es/1#y": ("a.net", "/es/1", "net/es/", "block"),
        "http://notnet/es/": ("notnet", "/es/", None, "allow"),
        "http://spam-farm.example.org/": ("spam-farm.example.org", "/", None, "block"),
        "http://a.com": ("a.com", "", None, "allow"),
        "a.com/en/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] * 2, "page_id long, url string, verdict string")
    found = urlfilter.judge_pages(pages).collect()
    assert len(found) == 2 * len(cases)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == list(cases.values())[r.page_id]
    assert urlfilter.judge_pages(pages.limit(0)).count() == 0


def test_rare_token_index(spark):
    targets = spark.createDataFrame([("a.common.x/",), ("b.common.y/",)], "target string")
    rules = urlfilter.rule_table(spark, [urlfilter.Rule("r", "||common.x/", "block"), urlfilter.Rule("s", "*part*", "block")])
    rows = {r["name"]: r["token"] for r in urlfilter.index_rules(targets, rules).collect()}
    assert rows == {"r": "x", "s": ""}


def test_a_filter_list_is_read(spark, folder):
    with open(f"{folder}/list.txt", "w") as f:
        f.write("[Adblock Plus 2.0]\n! comment\n\n||ads.example.com^\n@@||ads.example.com/ok/\n/banner/*/img^\r\n||ads.example.com^\n##.ad\nx.com#@#.b\n||t.com^$third-party\n/re[0-9]+/\n  |http\n")
    rules = {tuple(r) for r in urlfilter.read_rules(spark, f"{folder}/list.txt").collect()}
    assert rules == {
        ("||ads.example.com^", "||ads.example.com^", "block", 0),
        ("@@||ads.example.com/ok/", "||ads.example.com/ok/", "allow", 1),
        ("/banner/*/img^", "/banner/*/img^", "block", 0),
        ("|http", "|http", "block", 0),
    }
    assert {r.line for r in urlfilter.other_lines(spark, f"{folder}/list.txt").collect()} == {"##.ad", "x.com#@#.b", "||t.com^$third-party", "/re[0-9]+/"}
    urls = ["http://ads.example.com", "http://x.ads.example.com/a", "http://ads.example.com/ok/b", "http://bads.example.com/", "http://c.de/banner/1/2/img?x", "http://c.de/banner/1/imgs"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r.verdict for r in urlfilter.filter_urls(pages, urlfilter.read_rules(spark, f"{folder}/list.txt")).collect()}
    assert [found[k] for k in range(len(urls))] == ["block", "block", "allow", "allow", "block", "allow"]


def test_many_rules_equal_brute_force(spark, folder):
    """20,000 rules with anchors, wildcards, separators, ends, odd characters and exceptions."""
    rng = random.Random(13)
    words = ["ads", "track", "img", "shop", "news", "blog", "a", "b1", "x9", "promo", "cdn", "static", *(f"w{k}" for k in range(400))]
    ends = ["com", "net", "org", "de", "co.uk"]

    def host():
        return ".".join([*(rng.choice(words) for _ in range(rng.randint(1, 3))), rng.choice(ends)])

    def rule():
        path = "/".join(rng.choice(words) for _ in range(rng.randint(0, 2)))
        body = rng.choice([f"||{host()}^", f"||{host()}/{path}", f"/{path}/*", f"/{rng.choice(words)}*{rng.choice(words)}/^", f"||{rng.choice(words)}-*.", f"{rng.choice(words)}.{rng.choice(ends)}/{path}|", f"?{rng.choice(words)}=", f"/{rng.choice(words)}(1)+[x]{{2}}.", f"é{rng.choice(words)}^"])
        return ("@@" if rng.random() < 0.2 else "") + body

    lines = sorted({r for r in (rule() for _ in range(45_000)) if len(r) > 3})[:20_000]
    assert len(lines) > 15_000
    with open(f"{folder}/list.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    urls = [f"http://{host()}/{'/'.join(rng.choice([*words, 'w1-w2', 'ads(1)+[x]{2}.y', 'éads']) for _ in range(rng.randint(0, 3)))}{rng.choice(['', '/', '?ads=1', '?w5=x#z', '.gif'])}" for _ in range(250)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: (r.matched, r.verdict) for r in urlfilter.filter_urls(pages, urlfilter.read_rules(spark, f"{folder}/list.txt")).collect()}
    compiled = [(name, name.startswith("@@"), re.compile(urlfilter.rule_regex(name.removeprefix("@@")).replace(r"\z", r"\Z"))) for name in lines]
    for k, url in enumerate(urls):
        fits = [(allowed, len(name), name) for name, allowed, regex in compiled if regex.search(url.split("://")[1])]
        best = max(fits, default=None)
        assert found[k] == ((best[2], "allow" if best[0] else "block") if best else (None, "allow"))
    assert sum(v == "block" for _, v in found.values()) > 20 and sum(m is not None and v == "allow" for m, v in found.values()) > 10


def test_pieces_equal_the_library(spark, odd):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = vocabulary("piece_bpe_32k.model")
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path)
    texts = [t or "" for t in ODD] + noise(1, "ab e▁ \né日😀theTHE<>_=-0\t1ሴ", 800, 60) + [" " * 90, "ab" * 300, "=-" * 99]
    ids, counts, written = model.encode(texts)
    expected = [library.encode(t) for t in texts]
    assert written == [",".join(map(str, e)) for e in expected]
    assert ids.tolist() == sum(expected, []) and counts.tolist() == list(map(len, expected))
    assert [x.decode() for x in model.decode(ids, counts)] == [library.decode(e) for e in expected]
    rng = random.Random(2)
    loose = [[rng.randint(0, 700) for _ in range(rng.randint(0, 9))] for _ in range(500)]
    back = model.decode(np.array(sum(loose, [])), np.array(list(map(len, loose))))
    assert [x.decode() for x in back] == [library.decode(e) for e in loose]
    found = pieces.encode_documents(odd, path).collect()
    assert len(found) == len(ODD) + 2
    assert all(r.ids == library.encode(ODD[r.doc_id] or "") for r in found if r.doc_id is not None)
    assert pieces.digest_documents(odd.limit(0), path).count() == 0


@pytest.mark.parametrize("word", ["letters", "few", "a", "ab", "the", "ational", "mixed"])
def test_one_very_long_word(word):
    sentencepiece = pytest.importorskip("sentencepiece")
    path, rng = vocabulary("piece_bpe_32k.model"), random.Random(8)
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load(path)
    alphabet = {"letters": "abcdefghijklmnopqrstuvwxyz", "few": "etaoins", "mixed": "éab日😀=-THe1"}.get(word)
    text = "".join(rng.choice(alphabet) for _ in range(30_000)) if alphabet else word * (30_000 // len(word))
    for t in (text, f"x {text} y", "z" + text[:3000]):
        assert model.encode([t])[0].tolist() == library.encode(t)


def test_a_word_of_a_million_letters_takes_seconds():
    path, rng = vocabulary("piece_bpe_32k.model"), random.Random(8)
    model = pieces.load(path)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    start = time.perf_counter()
    ids, counts, _ = model.encode([text])
    assert time.perf_counter() - start < 10 and counts[0] == len(ids) > 300_000
    assert model.decode(ids, counts) == [text.encode()]


def test_models_with_other_rules_are_refused():
    sentencepiece = pytest.importorskip("sentencepiece")
    from sentencepiece import sentencepiece_model_pb2

    own = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(own.serialized_model_proto())
    model.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="squeezed"):
        pieces._check_rules(model.SerializeToString())


def test_token_files_read_back(spark, odd, folder):
    tokenizers = pytest.importorskip("tokenizers")
    path = vocabulary("word_bpe_49k.json")
    texts = noise(3, "ab e\n日😀theTHE'sll<>|_=-0\t1ሴ\x1c\x85\xa0İß", 400, 60)
    rows = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").unionAll(odd.select("doc_id", "text"))
    index = tokenfile.write_sequences(rows, folder, path, 2, length=64)
    found = {}
    for r in tokenfile.read_digests(index, folder).collect():
        found.setdefault(r.doc_id, []).append(r)
    library, at = tokenizers.Tokenizer.from_file(path), 0
    listed = collections.defaultdict(list)
    for r in rows.collect():
        listed[r.doc_id].append(r.text or "")
    for doc in sorted(listed, key=lambda d: -1 if d is None else d):
        for text, r in zip(listed[doc], sorted(found[doc], key=lambda r: r.start), strict=True):
            ids = [*library.encode(text, add_special_tokens=False).ids, 2]
            assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            at += len(ids)
    first = index.orderBy("part").first()
    tokens, mask = tokenfile.SequenceFile(f"{folder}/sequences", first.file).sequence(0)
    assert len(tokens) == len(mask) == 64 and tokens.dtype == np.uint16
    assert tokenfile.store_and_verify(rows.limit(0), path).count() == 0


def brute_components(rows):
    """(row number -> smallest id reachable) by comparing all documents that share a shingle."""
    sets = [set(shingles(t)) for _, t in rows]
    holders, shared = collections.defaultdict(list), collections.Counter()
    for k, own in enumerate(sets):
        for s in own:
            holders[s].append(k)
    for held in holders.values():
        shared.update((a, b) for i, b in enumerate(held) for a in held[:i])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return [(doc, len(sets[k]), least.get(find(k))) for k, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize("small,hubs", [(64, 3), (2, 1)])
def test_ngram_join_equals_brute_force(spark, odd, docs, monkeypatch, small, hubs):
    monkeypatch.setattr(ngramjoin, "SMALL", small)
    monkeypatch.setattr(ngramjoin, "HUBS", hubs)
    rng = random.Random(5)
    rows = [(r.doc_id + 1000, r.text) for r in docs.limit(250).collect()]
    base = "w1 w2 " + " ".join(f"t{k}" for k in range(90))
    for k in range(60):
        words = base.split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"n{rng.randint(0, 40)}"
        rows.append((5000 + k, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string").unionAll(odd.select("doc_id", "text"))
    rows = [(r.doc_id, r.text) for r in table.collect()]
    found = [tuple(r) for r in ngramjoin.join_documents(table).collect()]
    assert sorted(found, key=repr) == sorted(brute_components(rows), key=repr)
    kept = [(r.doc_id, r.text) for r in ngramjoin.drop_near_copies(table).collect()]
    assert len(kept) == len({c for _, n, c in found if n}) + sum(n == 0 for _, n, _ in found)
    assert ngramjoin.join_documents(table.limit(0)).count() == 0


def test_shingles_that_share_48_bits_are_two(monkeypatch):
    import pyarrow as pa

    near = np.array([7 << 16, (7 << 16) + 1, 1 << 63], np.uint64)
    monkeypatch.setattr(ngramjoin, "text_shingles", lambda data, offsets: (near, np.array([3])))
    ((_, (items,)),) = ngramjoin.document_sets(pa.array(["a b c d e f g"]))
    assert len(items) == 3 and ngramjoin.unpack(ngramjoin.pack([items])[0].as_py()).tolist() == sorted(near.tolist())


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    for size, other in ((1, 1), (30, 37), (200, 200), (500, 620)):
        both = np.unique(rng.integers(0, 1 << 63, 2 * (size + other), dtype=np.uint64))
        for shared in {0, size // 2, size - 1, size}:
            x, y = both[:size], both[size - shared : size - shared + other]
            apart = ngramjoin.sketch_distance(ngramjoin.sketch(x), ngramjoin.sketch(y))
            assert apart <= size + other - 2 * shared and apart == ngramjoin.sketch_distance(ngramjoin.sketch(y), ngramjoin.sketch(x))
    assert len(ngramjoin.sketch(both[:1000])) * 16 <= both[:1000].nbytes


def test_sets_of_a_large_group_are_sent_once_each(spark, monkeypatch):
    """A clique, a set below the threshold of all others and a pair of its own."""
    sent = []

    def verify(pairs, sets):
        sent.append(sorted(tuple(r) for r in pairs.collect()))
        return checked(pairs, sets)

    checked = ngramjoin.verify
    monkeypatch.setattr(ngramjoin, "verify", verify)
    base = np.arange(1000, 1100, dtype=np.uint64)
    own = {k: np.concatenate([base[:99], [np.uint64(5000 + k)]]) for k in range(12)}
    own |= {20: np.concatenate([base[:50], np.arange(9000, 9050, dtype=np.uint64)]), 30: base + np.uint64(70000), 31: base + np.uint64(70000)}
    own = {k: ngramjoin.mix(v) for k, v in own.items()}
    rows = [(k, len(v), ngramjoin.sketch(v), v.astype("<u8").tobytes()) for k, v in own.items()]
    sets = spark.createDataFrame([(k, n, bytearray(x), bytearray(y)) for k, n, x, y in rows], "key long, n int, sketch binary, items binary")
    pairs = spark.createDataFrame([(a, b) for a in own for b in own if a < b and (a < 30) == (b < 30)], "a long, b long")
    found = ngramjoin.connect(ngramjoin.find_links(pairs, sets))
    assert sorted(tuple(r) for r in found.collect()) == [(k, 0) for k in range(12)] + [(30, 30), (31, 30)]
    assert sent == [[(0, k) for k in range(1, 12)] + [(30, 31)]]


def test_shuffle_files_go_with_the_write(spark):
    from lendframe.session import DROP_SHUFFLES, cut_lineage

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().endswith(".data")}

    before = files()
    kept = cut_lineage(spark.range(100_000).repartition(7, "id").groupBy("id").count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 100_000
    assert spark.conf.get(DROP_SHUFFLES, "false") == "false"


def test_trie_shares_and_prunes():
    probe = np.arange(0, 100, dtype=np.uint64)
    near, far, longer = probe[5:].copy(), np.arange(500, 600, dtype=np.uint64), np.arange(0, 130, dtype=np.uint64)
    assert ngramjoin.trie_links(probe, [near, far, longer, probe]).tolist() == [True, False, False, True]


def test_leaks_equal_brute_force(spark, odd, docs):
    items = spark.createDataFrame([(1, "dup text"), (2, None), (3, ""), (4, "dup text dup")], "item_id long, text string")
    items = items.unionAll(spark.read.parquet(f"{SF1}/benchmark.parquet").selectExpr("item_id + 100", "text"))
    table = docs.select("doc_id", "text").unionAll(odd.selectExpr("doc_id + 100000", "text"))
    best = collections.Counter()
    wanted = {r.item_id: collections.Counter(shingles(r.text)) for r in items.collect() if r.item_id > 4}
    for r in table.collect():
        own = shingles(r.text)
        for item, target in wanted.items():
            hits = [k for k, s in enumerate(own) if s in target]
            n = min(sum(target.values()), len(own))
            for at in {max(0, min(k - j, len(own) - n)) for k in hits for j in range(n)}:
                both = sum((collections.Counter(own[at : at + n]) & target).values())
                similar = both / (n + sum(target.values()) - both)
                if similar >= 0.8:
                    best[r.doc_id, item] = max(best[r.doc_id, item], similar)
    found = decontaminate.find_leaks(table, items).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in found if r.item_id > 4} == pytest.approx(dict(best))
    assert {(r.doc_id, r.item_id) for r in found if r.item_id <= 4} == {(100000 + k, i) for k in (10, 11) for i in (1, 4)}
    kept = decontaminate.drop_leaked(table, items).count()
    assert kept == table.count() - len({r.doc_id for r in found})
    assert decontaminate.find_leaks(table.limit(0), items).count() == decontaminate.find_leaks(table, items.limit(0)).count() == 0


def test_language_held_out(spark, odd, docs):
    model = langid.fit(docs.filter(langid.remainder("doc_id", 5) != 0), 120)
    rows = docs.join(langid.predict_languages(docs, model), "doc_id").filter(langid.remainder("doc_id", 5) == 0).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    found = {r.doc_id: r for r in langid.predict_languages(odd, model).collect()}
    assert len(found) == len(ODD) + 1
    assert all(found[k].lang_pred == "und" and found[k].score == 0 and found[k].rejected for k in (0, 1, 2, 3, 7))
    assert all(0 <= r.score <= 1 for r in found.values())
    assert {r.lang_pred for r in langid.identify(odd.drop("lang").selectExpr("*", "cast(null as string) as lang")).collect()} == {"und"}
    assert langid.identify(odd.limit(0)).count() == 0


def test_quality_held_out(spark, odd, docs):
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    rows = quality.judge_quality(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    found = quality.judge_quality(odd, labels).collect()
    assert len(found) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in quality.judge_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_all_are_kept_where_no_quality_is_learned(spark, odd):
    one = spark.createDataFrame([(k, 1) for k in range(12)], "doc_id long, quality int")
    for labels in (one, one.limit(0), one.selectExpr("doc_id + 1000 as doc_id", "quality")):
        kept = quality.keep_good(odd, labels)
        assert kept.columns == odd.columns and kept.count() == odd.count()


def test_page_blocks():
    page = """<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><header>Site</header>
    <nav><ul><li><a href=x>One</a></li></ul></nav><div class="cookie-notice">We use cookies on this site</div>
    <article><h1>A &amp; B</h1><p>Some <b>bold</b>text&nbsp;here<p>second<br>line 1 &lt; 2<div class="share">Share me</div>
    <section id="comments"><p>Great post by a reader</p></section></article>
    <aside>More</aside><form><p>Sign up</p></form><footer>&copy; us</footer></body></html>"""
    assert htmltext.main_text(page) == "A & B Some boldtext here second line 1 < 2"
    prose = "this is the kind of text that has a lot of the words which are in all of the texts and it is long"
    assert htmltext.main_text(f"<div><p>{prose}</p><p>Short one</p><p>{prose}</p><p><a href=a>Link</a> <a href=b>Other link</a></p></div>") == f"{prose} Short one {prose}"
    assert htmltext.main_text("") == "" and htmltext.main_text("just text") == "just text"


def test_page_articles_inside_apart_containers():
    prose = "this is the kind of text that has a lot of the words which are in all of the texts and it is long"
    article = f"<article><h1>Head</h1><p>{prose}</p><div class='share-buttons'>Share</div><form><p>Sign up</p></form><aside>{prose}</aside></article>"
    for opened, closed in (("<form action=x>", "</form>"), ("<div class='site has-sidebar'>", "</div>"), ("<section class=with-nav>", "</section>"), ("<div class=sidebar>", "</div>"), ("<header>", "</header>")):
        page = f"<body>{opened}<nav><a href=x>Menu</a></nav>{article}<div id='comments'><article><p>{prose}</p></article></div><div class='site-footer'>{prose}</div>{closed}</body>"
        assert htmltext.main_text(page) == f"Head {prose}", opened
    assert htmltext.main_text(f"<form><nav>Menu</nav><h1>Head</h1><p>{prose}</p></form>") == f"Head {prose}"
    assert htmltext.main_text(f"<p>{prose}</p><p>{prose}</p><form><p>{prose}</p></form><div class=sidebar><article>{prose}</article></div>") == f"{prose} {prose}"
    assert htmltext.main_text(f"<main><p>{prose}</p></main><div class=sidebar><article>{prose}</article></div>") == prose


def test_page_elements_without_end():
    for odd in ("<svg viewBox='0 0 1 1'/>", "<svg><path d=x></svg>", "<svg><path d=x>", "<button>Share", "<button><div>Share</div></button>", "<select><option>A<option>B", "<template><p>No</p></template>", "<button>A <svg><path/></svg>"):
        for page in (f"<article><p>one {odd}</p><p>two</p></article>", f"<article>one {odd}<p>two</p></article><footer>Us <button>B</button><svg></svg></footer>", f"<article>one<div>{odd}</div><p>two</p></article>"):
            assert htmltext.main_text(page) == "one two", page
    assert htmltext.main_text("<article><p>one <object data=x>two</p><p>three <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> four</p></article>") == "one two three x=1 four"
    assert htmltext.main_text("<head><noscript><link></head><body><noscript>No script</noscript><article><noscript><p>one</p></noscript><p>two</p></article>") == "one two"
    assert htmltext.main_text("<article>one <iframe>no</iframe><textarea>no") == "one"


def test_page_prose_in_other_languages():
    menu, links = "<nav><a href=a>Menu</a></nav>", "<p>" + " ".join(f"<a href=a>mot{k}</a>" for k in range(20)) + "</p>"
    english = "this is the kind of text that has a lot of the words which are in all of the texts and it is long"
    for prose in (
        "Wczoraj wieczorem mieszkańcy miasta zebrali się przed ratuszem, żeby wysłuchać przemówienia burmistrza oraz zadać pytania dotyczące budowy mostu",
        "Вчера вечером жители города собрались перед ратушей, чтобы выслушать речь мэра и задать вопросы о строительстве нового моста через реку",
        "Dün akşam şehir sakinleri belediye binasının önünde toplanarak başkanın konuşmasını dinledi ve yeni köprünün yapımı hakkında sorular sordu",
        "昨天晚上市民们聚集在市政厅前听取市长的讲话并就新桥的建设提出了许多问题市长回答说工程将于明年春天开始",
        "Kemarin malam warga kota berkumpul depan balai kota untuk mendengarkan pidato wali kota serta mengajukan pertanyaan tentang pembangunan jembatan baru",
    ):
        page = f"{menu}<div><h1>Title</h1><p>{prose}</p><p>{prose}</p>{links}</div><footer>Us</footer>"
        assert htmltext.main_text(page) == f"Title {prose} {prose}", prose
    junk = "cheap tickets hotel flights casino poker bonus slots loans credit mortgage pills watches replica luxury brands"
    assert htmltext.main_text(f"<p>{english}</p><p>{english}</p><p>{junk}</p>") == f"{english} {english}"


def test_pages_equal_their_articles(spark):
    import html

    pages = spark.read.parquet(f"{SF1}/pages.parquet")
    found = {r.page_id: r for r in htmltext.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        text = " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert found[r.page_id].text == text and found[r.page_id].n_chars == len(text)
    rows = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>a</p>", "x")], "page_id long, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in htmltext.extract(rows).collect()) == [("", 0), ("", 0), ("a", 1)]


@pytest.mark.parametrize("tags,names", [("article", False), ("article", True), ("article|nav|aside|header|footer|main", True)])
def test_pages_without_semantic_tags(spark, tags, names):
    """Density, length and links find the article where nothing names it."""
    import html

    right = found = true = 0
    for r in spark.read.parquet(f"{SF1}/pages.parquet").collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        text = html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split()
        page = re.sub(rf"(</?)(?:{tags})\b", r"\1div", r.html)
        page = re.sub(' class="[^"]*"', "", page) if names else page
        assert "<article" not in page
        given = collections.Counter(htmltext.main_text(page).split())
        right += sum((given & collections.Counter(text)).values())
        found, true = found + sum(given.values()), true + len(text)
    assert right >= 0.98 * true and right >= 0.98 * found


@pytest.mark.parametrize("unit", ["<p a='", "<a ", "<a '\">", '<x "', "<p a='>", "<!-- ", "<script '", "<div class='a", "</", '<a href="<b">x', "<select><p>", "<div><p>some words "])
@pytest.mark.parametrize("tail", ["", ">"])
def test_broken_tags_take_no_longer_than_others(unit, tail):
    page = (unit * (1_000_000 // len(unit))) + tail
    start = time.perf_counter()
    htmltext.main_text(page)
    assert time.perf_counter() - start < 2


def test_what_nothing_closes_ends_the_text():
    assert htmltext.main_text("<p>a b</p><!-- c <p>d") == "a b"
    assert htmltext.main_text("<p>a b</p> tail <!-- c") == "a b tail"
    assert htmltext.main_text("<p>a b</p><script>var x = 1 > 0;") == "a b"
    assert htmltext.main_text("<p>a b</p><!-- c -->d 1 < 2") == "a b d 1 < 2"
    assert htmltext.main_text('<p title="x < y > z">a</p>') == "a"


def test_links_of_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    rows = []
    for k in range(900):
        v = centres[k % 30] + rng.normal(size=16) * (0.05 if k % 3 else 0.6)
        rows.append((k, v.astype(np.float32).tolist(), int(k % 2)))
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] + [1.0] * 15, 1), (2004, rows[0][1], None), (2005, [1.0], 0), rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    values = {i: (np.array(v, float), label) for i, v, label in rows if i < 1000}
    ids = sorted(values)
    unit = np.stack([values[i][0] / np.linalg.norm(values[i][0]) for i in ids])
    same = np.array([values[i][1] for i in ids])
    linked = (unit @ unit.T >= 0.93) & (same[:, None] == same)
    np.fill_diagonal(linked, False)
    for shard in (8192, 150):
        found = {r.vec_id: r for r in neighbours.link_vectors(table, shard).collect()}
        assert len(found) == 906
        counts = np.array([found[i].n_links for i in ids])
        assert (counts <= linked.sum(axis=1)).all() and counts.sum() >= 0.9 * linked.sum()
        assert all(found[i].n_links == 0 and found[i].component_id == i and found[i].kept for i in range(2000, 2006))
        assert all(found[i].component_id == min([i, *(j for j in ids if found[j].component_id == found[i].component_id)]) for i in ids[:40])
    assert neighbours.link_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [8192, 2])
def test_every_row_of_a_repeated_id_is_compared(spark, shard):
    x, y, z = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = [(1, x, 0), (2, x, 0), (2, y, 0), (2, y, 0), (3, y, 0), (4, z, None), (4, z, 0), (5, z, 0), (6, x, 1), (6, z, 1), (3, y, 1), (2, y, 1), (None, x, 0), (None, x, 0), (7, None, 0)]
    found = neighbours.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), shard).collect()
    assert sorted(tuple(r)[:3] for r in found if r.vec_id) == [(1, 1, 1), (2, 2, 1), (3, 1, 1), (4, 1, 4), (5, 1, 4), (6, 0, 6), (7, 0, 7)]
    assert [r.n_links for r in found if r.vec_id is None] == [0, 0]


def test_audits_see_unreachable_and_small_groups():
    rng = np.random.default_rng(9)
    hot = np.tile(rng.normal(size=8), (600, 1)) + rng.normal(size=(600, 8)) * 1e-3
    pairs = np.repeat(rng.normal(size=(100, 8)), 2, axis=0) + rng.normal(size=(200, 8)) * 1e-3
    for vectors in (np.vstack([hot, pairs]), pairs):
        units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        same = units @ units.T >= neighbours.COSINE
        np.fill_diagonal(same, False)
        graph = neighbours.Graph.build(units.astype(np.float32))
        for layer in graph.layers:  # cut the pairs off
            layer[-200:] = -1
            layer[layer >= len(vectors) - 200] = -1
        row, node = neighbours.links_between(vectors, graph, vectors, True)
        assert set(zip(row.tolist(), node.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(same))))


def brute_spans(text):
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(int(d) * 2 - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
            fine = (True, all(int(p or 0) <= 255 for p in m[0].split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and doubled % 10 == 0, 10 <= len(digits) <= 15)[kind]
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data_base_spans(spark, odd, docs):
    alphabet = ["a", "b", ".", "@", "-", "_", "1", "2", "5", "0", " ", "+", "(", ")", "é", "😀", "\n", "4111111111111111", "x@y.zz", "1.2.3.4", "..", "+1 (974) 555-3436", "255", "256", "00"]
    texts = noise(7, alphabet, 600, 40) + ["a." * 3000 + "@" + "b." * 3000, "1." * 5000, "1 " * 5000, "mail me: a.b@mail3.example.com, card 4371 2900 8412 5426"]
    table = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string").unionAll(odd.select("doc_id", "text"))
    by_id = {r.doc_id: r.text or "" for r in table.collect()}
    found = pii.report(table.unionAll(docs.selectExpr("doc_id + 50000", "text"))).filter("doc_id < 50000 or doc_id is null").collect()
    assert len(found) == table.count()
    for r in found:
        spans = brute_spans(by_id[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        base = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) | {""}
    assert pii.report(odd.limit(0)).count() == 0


def test_redaction(spark, odd):
    rows = spark.createDataFrame([(1, "write to ab@cd.ef or 10.0.0.1!", "b", "t"), (2, None, "b", "t")], "doc_id long, text string, base string, spans string")
    found = {r.doc_id: r for r in pii.redact(rows).collect()}
    assert found[1].text == "write to [EMAIL] or [IP]!" and found[2].text is None and found[1].base == "b"
    assert pii.redact(odd).columns == odd.columns


def test_vote_patterns_are_weighed():
    rows = [("phone", (1, 1, 1, 0), (2, 3, 1, 0), 900), ("phone", (0, -1, -1, 0), (2, 1, 1, 2), 800), ("phone", (0, 1, 1, 1), (2, 3, 1, 1), 30)]
    likely = pii.estimate(rows)
    assert likely["phone", (1, 1, 1, 0)] > 0.95 and likely["phone", (0, -1, -1, 0)] < 0.05


def test_pipeline_stages(spark, odd):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        before, table = table, stage(spark, table, SF)
        sizes.append(table.count())
        if name != "encode":
            assert table.columns == before.columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd, SF).count() >= 0
        assert stage(spark, odd.limit(0), SF).count() == 0
    assert sorted(corpus_pipeline.run(spark, SF).columns) == ["decoded_sha256", "doc_id", "ids_sha256", "n_tokens"]


def test_pipeline_rows_equal_brute_force(spark):
    sentencepiece = pytest.importorskip("sentencepiece")
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality.judge_quality(docs, labels).filter("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id in good]
    rows = [(doc, text) for (doc, text), (_, n, first) in zip(rows, brute_components(rows), strict=True) if not n or doc == first]
    items = [collections.Counter(shingles(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        own = shingles(text)
        for target in items:
            n = min(sum(target.values()), len(own))
            hits = [k for k, s in enumerate(own) if s in target]
            for at in {max(0, min(k - j, len(own) - n)) for k in hits for j in range(n)}:
                both = sum((collections.Counter(own[at : at + n]) & target).values())
                if both >= 0.8 * (n + sum(target.values()) - both):
                    return True
        return False

    rows = [(doc, text) for doc, text in rows if not leaks(text)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in pii.report(table).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    expected, replaced = [], 0
    for doc, text in rows:
        out, at = "", 0
        for a, b, kind in sorted((int(a), int(b), kind) for kind, a, b in spans[doc]):
            if a >= at:
                out, replaced = f"{out}{text[at:a]}[{kind.upper()}]", replaced + 1
            at = max(at, b)
        ids = library.encode(out + text[at:])
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        expected.append((doc, len(ids), *digests))
    assert replaced and 0 < len(rows) < len(good) < docs.count()
    found = corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(tuple(r) for r in found) == sorted(expected)
