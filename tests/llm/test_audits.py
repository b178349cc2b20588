"""Source audit, vector codes and repeated passages against SQL and brute force, with odd rows."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from compare import compare, connect

import __spark_entry__ as driver
import corpus_pipeline
from lendframe.llm import decontaminate, divergence, neighbours, pii, recompression, substrings, vectorcodes
from lendframe.llm.shingles import words
from lendframe.llm.transducer import Streamer, Transducer
from lendframe.session import cut_lineage

SF1 = "/root/testdata/sf0.01"
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name,rows", [("op11_source_divergence", None), ("op12_vector_codes", 500), ("op13_substring_dedup", 1000)])
def test_queries_equal_sql(spark, name, rows):
    verdict, found = compare(spark, connect(SF1), SF1, name, driver.queries()[name], driver.oracle_sql()[name])
    assert verdict == "equal" and found == (rows or found) and found


# transducers


def test_transducer_numbers_terms_and_spells_them():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abcé日") for _ in range(rng.randint(1, 9))).encode() for _ in range(3000)})
    made = Transducer.build(terms)
    assert [made.term(k) for k in range(len(terms))] == terms
    # no two states alike: the automaton is minimal
    forms = collections.defaultdict(list)
    for key, target in zip(made.keys.tolist(), made.targets.tolist()):
        forms[key >> 8].append((key & 255, target))
    states = [(bool(end), tuple(forms[k])) for k, end in enumerate(made.ends[:-1])]
    assert len(set(states)) == len(states)
    assert len(made.ends) < sum(len(t) for t in terms) / 2


def test_streamer_finds_the_terms_of_each_group_in_parts_of_any_size():
    rng = random.Random(2)
    groups = [sorted({"aaaaaaaa" * (rng.random() < 0.3) + "".join(rng.choice("ab") for _ in range(rng.randint(1, 12))) for _ in range(300)}) for _ in range(2)]
    parts, number = [], 0
    for group, terms in enumerate(groups):
        for at in range(0, len(terms), 17):
            own = [t.encode() for t in terms[at : at + 17]]
            parts.append((group, own[0], number, at, Transducer.build(own)))
            number += 1
    streamer = Streamer(parts)
    asked = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(500)] + groups[0] + groups[1]
    data = np.frombuffer("".join(asked).encode(), np.uint8)
    stops = np.cumsum([len(a) for a in asked])
    starts = np.concatenate([[0], stops[:-1]])
    for group in (-1, 0, 1):
        found, numbers = streamer.look_up(data, starts, stops, np.full(len(asked), group))
        expected = [groups[group].index(a) if group >= 0 and a in groups[group] else -1 for a in asked]
        assert found.tolist() == expected
        assert all(parts[n][0] == group and parts[n][3] <= f < parts[n][3] + 17 for f, n in zip(found, numbers) if f >= 0)


# source audit


def brute_audit(rows, least):
    documents, counts, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for text, lang, source in rows:
        lang, source, found = lang or "", source or "", TERMS.findall((text or "").translate(LOWER))
        documents[lang].update(set(found))
        counts[lang, source].update(found)
        groups.add((lang, source))
    kept = {lang: sorted((t for t, n in c.items() if n >= least), key=str.encode) for lang, c in documents.items()}
    out = []

    def p(n, total, v):
        return 1 + 10**9 * (n + 2) // (total + 2 * v)

    for lang, source in groups:
        terms, own = kept[lang], counts[lang, source]
        total = {s: sum(counts[lang, s][t] for t in terms) for l, s in groups if l == lang}
        share = {s: [p(counts[lang, s][t], total[s], len(terms)) for t in terms] for s in total}
        pairs = [(-sum((a - b) ** 2 // (a + b) for a, b in zip(share[source], share[s])), s) for s in total if s != source]
        out += [(lang, source, "pair", s, -v, k + 1) for k, (v, s) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
        whole = {t: p(sum(counts[lang, s][t] for s in total), sum(total.values()), len(terms)) for t in terms}
        leading = [(-((a - whole[t]) ** 2 // (a + whole[t])), t) for t, a in zip(terms, share[source]) if own[t] and a > whole[t]]
        out += [(lang, source, "term", t, -v, k + 1) for k, (v, t) in enumerate(sorted(leading, key=lambda x: (x[0], x[1].encode()))[:10])]
    return sorted(out)


def odd_documents():
    rng = random.Random(3)
    vocabulary = ["the", "The", "été", "日本", "a", "b", "c", "zz", "İ", "don't", "x1y", "\U0001f600", "ab_cd", "Ångström"]
    rows = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 30))), rng.choice(["en", "en", "fr", None, ""]), rng.choice(["s1", "s2", "é", None, "Z"])) for _ in range(300)]
    rows += [(None, "en", "s1"), ("", "xx", "lonely"), ("only once", "xx", "other"), (None, None, None), ("the " * 30_000, "en", "long"), ("the a b", "fr", "s1"), ("the a b", "fr", "s1")]
    return rows


@pytest.mark.parametrize("segment,block,tile", [(divergence.SEGMENT, divergence.BLOCK, divergence.TILE), (3, 2, 2)])
def test_source_audit_equals_brute_force(spark, monkeypatch, segment, block, tile):
    rows = odd_documents()
    table = spark.createDataFrame([(i % 40 or None, *r, 1, "k") for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, value long, term string").repartition(3)
    if segment == 3:
        monkeypatch.setattr(divergence, "PASS_BYTES", 500)
    found = sorted(tuple(r) for r in divergence.audit(table, segment, block, tile).select("lang", "source", "part", "item", "value", "rank").collect())
    assert found == brute_audit(rows, divergence.DOCS)
    assert divergence.audit(table.limit(0)).count() == 0


def test_shares_beyond_64_bits_are_exact(spark):
    count, total, terms = 4 * 10**12, 9 * 10**14, 10**7
    row = spark.range(1).selectExpr(f"{count}L as count", f"{total}L as total", f"{terms}L as terms").select(divergence.share("count", "total", "terms").alias("p")).first()
    assert row.p == 1 + 10**9 * (count + 2) // (total + 2 * terms)


# vector codes


def brute_codes(rows):
    """``rows`` of (vec_id, label, vector); vectors of one length, ids that don't repeat."""
    kept = [(i, l, [math.floor(4096 * x) if abs(x) < 2**50 else 4096 * int(x) for x in v]) for i, l, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-len(kept[0][2]) // 8)
    kept = [(i, l, [tuple((v + [0] * 8)[p * width : (p + 1) * width]) for p in range(8)]) for i, l, v in kept]
    seeds = sorted((k for k in kept if k[0] is not None), key=lambda k: k[0])[:16]
    books = [[s[2][p] for s in seeds] for p in range(8)]

    def nearest(book, part):
        d = [sum((x - y) ** 2 for x, y in zip(e, part)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(6):
        for p in range(8):
            own = collections.defaultdict(list)
            for _, _, parts in kept:
                own[nearest(books[p], parts[p])[0]].append(parts[p])
            books[p] = [tuple(sum(c) // len(own[e]) for c in zip(*own[e])) if e in own else b for e, b in enumerate(books[p])]
    found = [(i, l, [nearest(books[p], parts[p]) for p in range(8)]) for i, l, parts in kept]
    errors = collections.Counter()
    for _, l, f in found:
        errors[l] += sum(d for _, d in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in f), sum(d for _, d in f), errors[l], digest) for i, l, f in found), key=repr)


def codes(spark, rows, kind="float"):
    table = spark.createDataFrame([(*r, "k", 1) for r in rows], f"vec_id long, label int, embedding array<{kind}>, code string, error int")
    return sorted((tuple(r) for r in vectorcodes.compress(table).collect()), key=repr)


@pytest.mark.parametrize("length,count", [(16, 200), (24, 9), (13, 60), (8, 1)])
def test_vector_codes_equal_brute_force(spark, length, count):
    rng = random.Random(length)
    rows = [(i, rng.choice([1, 2, None]), [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5001220703125]) for _ in range(length)]) for i in range(count)]
    rows += [(count + k, 1, v) for k, v in enumerate([None, [None] * length, [float("nan")] + [0.0] * (length - 1), [0.0] * (length - 1) + [float("inf")]])]
    assert codes(spark, rows) == brute_codes(rows)


def test_vector_codes_stay_exact_beyond_64_bits(spark):
    rng = random.Random(5)
    rows = [(i, 1, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 4, 12]) for _ in range(16)]) for i in range(80)]
    assert codes(spark, rows, "double") == [(*r[:2], r[2] if r[2] < 2**63 else None, None, r[4]) for r in brute_codes(rows)]


def test_vector_codes_of_odd_tables(spark):
    rows = [(5, 1, [0.5] * 16), (None, 1, [0.25] * 16), (5, 1, [0.0] * 16), (7, None, [1.0] * 8), (9, None, []), (5, 1, [0.5] * 16)]
    found = codes(spark, rows)
    assert [r[0] for r in found].count(5) == 3 and len(found) == 6
    assert all((r[1] is None) == (r[0] in (7, 9)) for r in found)
    assert all(r[1] in (None, "00" * 8) for r in found)
    assert codes(spark, [(None, 1, [0.5] * 16)])[0][:3] == (None, None, None)
    assert codes(spark, [(1, 1, []), (2, 1, [])])[0][1] == "00" * 8
    table = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert vectorcodes.compress(table).count() == 0


def test_gnat_settles_ties_by_index():
    rng = np.random.default_rng(1)
    for width in (1, 2, 5):
        for n in (1, 3, 16):
            entries, asked = rng.integers(-3, 4, (n, width)), rng.integers(-4, 5, (400, width))
            index, best = vectorcodes.Gnat(entries).nearest(asked)
            squares = ((asked[:, None] - entries) ** 2).sum(axis=2)
            assert (best == squares.min(axis=1)).all() and (index == squares.argmin(axis=1)).all()


def test_gnat_leaves_subtrees_out():
    """Far clusters: most entries are never compared with most parts."""
    rng, compared = np.random.default_rng(2), 0
    entries = np.concatenate([rng.integers(0, 50, (4, 8)) + 100_000 * k for k in range(4)])
    asked = np.concatenate([rng.integers(0, 50, (250, 8)) + 100_000 * k for k in range(4)])
    plain = vectorcodes._squared

    def counted(a, b):
        nonlocal compared
        compared += len(a)
        return plain(a, b)

    tree = vectorcodes.Gnat(entries)
    vectorcodes._squared = counted
    try:
        tree.nearest(asked)
    finally:
        vectorcodes._squared = plain
    assert compared < 0.6 * len(asked) * len(entries)


# repeated passages


def brute_repeats(texts, width=35):
    listed = [WORDS.findall(t or "") for t in texts]
    places = collections.Counter(tuple(w[i : i + width]) for w in listed for i in range(len(w) - width + 1))
    out = []
    for w in listed:
        gone = {j for i in range(len(w) - width + 1) if places[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((len(w), len(gone), kept))
    return out


def passages():
    rng = random.Random(4)

    def prose(n, size=60):
        return [f"w{rng.randint(0, size)}" for _ in range(n)]

    common, other = prose(50), prose(35)
    texts = [" ".join(prose(rng.randint(0, 80))) for _ in range(40)]
    texts += [" ".join(prose(rng.randint(0, 40)) + common + prose(rng.randint(0, 40))) for _ in range(30)]
    texts += ["\t\n ".join(prose(3) + other + prose(2)), " " + "  ".join(other) + "\r\n", " ".join(other[1:])]
    texts += ["x " * 34, "x " * 35, "y " * 36, "z " * 3000, "p q " * 18, "p q r " * 500, "a a a b " * 40, "a a b " * 40]
    texts += [None, "", " \n", "one", "é 日本 " * 60, "m n " * 36, "W1 " * 35, "w1 " * 20 + "W1 " * 15, "q" * 50_000]
    texts += [texts[3], texts[3], " ".join(prose(20) * 3), " ".join(prose(1, 1) * 90)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size", [substrings.BLOCK, 600])
def test_repeats_equal_brute_force(spark, monkeypatch, size):
    texts = passages()
    monkeypatch.setattr(substrings, "BLOCK", size)
    table = spark.createDataFrame([(i % 50 or None, t, "n", 3) for i, t in enumerate(texts)], "doc_id long, text string, name string, block long").repartition(3)
    found = collections.Counter(tuple(r) for r in substrings.remove_repeats(table).collect())
    assert found == collections.Counter((i % 50 or None, *b) for i, b in enumerate(brute_repeats(texts)))
    digests = {r.kept_sha256 for r in substrings.digest_documents(table).collect()}
    assert digests == {hashlib.sha256(b[2].encode()).hexdigest() for b in brute_repeats(texts)}
    assert substrings.remove_repeats(table.limit(0)).count() == 0


def test_equal_windows_have_equal_anchors():
    texts = [t or "" for t in passages()]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    starts, stops, counts = words(data, offsets)
    names = recompression.word_names(data, starts, stops)
    listed = [data[a:b].tobytes() for a, b in zip(starts, stops)]
    for width in (1, 2, 7, 35):
        window, size, found, place = recompression.anchors(names, counts, width)
        first = recompression.windows(counts, width)
        assert np.array_equal(np.cumsum(size) - size, window) and size.sum() == len(first)
        seen = {}
        for f, name, p in zip(first.tolist(), np.repeat(found, size).tolist(), np.repeat(place, size).tolist()):
            assert seen.setdefault(tuple(listed[f : f + width]), (name, p - f)) == (name, p - f)
            assert f <= p < f + width


def test_distant_windows_rarely_share_an_anchor():
    """Anchors cover most of a window: few names of unlike windows meet."""
    rng = np.random.default_rng(6)
    vocabulary = rng.integers(0, 1 << 62, 2000).astype(np.uint64)
    names = vocabulary[rng.zipf(1.3, 60_000) % 2000]
    _, _, found, place = recompression.anchors(names, np.array([len(names)]), 35)
    own = np.unique(np.stack([found, place.astype(np.uint64)]), axis=1)[0]
    assert len(own) < len(names) / 3
    _, times = np.unique(own, return_counts=True)
    assert times[times > 1].sum() < 0.2 * len(own)


# --- names and ids ------------------------------------------------------------

#: Names that the operators use for columns of their own.
TAKEN = """alone again rows key version leads __id __version __again __quality __text __base __spans score holder component label node n m a b item items
counts block blocks ids sizes texts name check times whole lang_pred token verdict host path rule start end kind spans text_ docs term number ordinal rank""".split()


def test_stages_take_any_extra_columns(spark):
    """Every stage on a table whose other columns have the names that operators use, in any case."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n in TAKEN if n not in docs.columns]
    wide = docs.select("*", *[F.lit(k).alias(n.upper() if k % 3 == 0 else n) for k, n in enumerate(names)])
    plain = docs
    for name, stage in corpus_pipeline.STAGES:
        plain, wide = (cut_lineage(stage(spark, x, sf)) for x in (plain, wide))
        if name == "encode":
            break
        assert wide.columns[: len(docs.columns)] == docs.columns and len(wide.columns) == len(docs.columns) + len(names)
        rows = [sorted(map(tuple, x.select(*docs.columns).collect()), key=repr) for x in (plain, wide)]
        assert rows[0] == rows[1] and rows[0]
        odd = wide.select(*[F.col(f"`{c}`") for c in wide.columns[len(docs.columns) :]]).distinct().collect()
        assert [tuple(r) for r in odd] == [tuple(range(len(names)))]


def test_item_ids_may_be_text_and_vector_ids_may_not(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    named = items.withColumn("item_id", F.concat(F.lit("item-"), F.col("item_id").cast("string")))
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, named).collect()}
    assert found == {(r.doc_id, f"item-{r.item_id}") for r in decontaminate.find_leaks(docs, items).collect()} and found
    with pytest.raises(TypeError, match="whole number"):
        neighbours.link_vectors(spark.createDataFrame([("x", [1.0], 1)], "vec_id string, embedding array<float>, label int"))


def test_vectors_of_any_size_are_linked(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1.01e200], 1), (3, [1e-200, 1e-200], 1), (4, [1e-320, 1e-320], 1), (5, [1e200, -1e200], 1), (6, [0.0, 0.0], 1)]
    found = neighbours.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 0, 5, True), (6, 0, 6, True)]


# --- personal data ------------------------------------------------------------


def test_time_for_many_spans_in_one_text_grows_with_their_number(spark):
    line = "Call +49 30 1234567 or mail a.b@c.de, host 10.1.2.3, card 4111 1111 1111 1111; tel +44 20 7946 0123\n"
    seconds = []
    for lines in (1, 5_000, 20_000):
        docs = spark.createDataFrame([(1, line * lines)], "doc_id long, text string")
        start = time.perf_counter()
        (row,) = pii.report(docs).collect()
        seconds.append(time.perf_counter() - start)
        assert (row.n_phone, row.n_email, row.n_ip, row.n_card) == (2 * lines, lines, lines, lines)
    # four times as many: sixteen times as long if every span met every other
    assert seconds[2] < 9 * seconds[1]
    spans = [s.split(":") for s in row.spans.split(",")]
    assert len(spans) >= 100_000 and spans[5][0] == "phone" and int(spans[5][1]) == len(line) + 5


def test_spans_in_blocks_equal_spans_one_by_one(spark, monkeypatch):
    rng = random.Random(11)
    parts = ["+49 30 1234567", "a.b@c.de", "10.1.2.3", "4111 1111 1111 1111", "030-555-1234", "john (at) mail.example.com", "日本", "x", "😀", "4111-1111-1111-1111 4111-1111-1111-1111", "call", "1.2.3.4.5.6"]
    rows = [(k, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 120)))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for size in (64, 100_000, 0):
        monkeypatch.setattr(pii, "LONG", size)
        monkeypatch.setattr(pii, "PART", 2048 if size == 64 else 7)
        found[size] = (sorted(map(tuple, pii.report(docs).collect())), sorted(map(tuple, pii.redact(docs).collect())))
    assert found[64] == found[100_000] == found[0]
    # a text made of its spans and what lies between them
    spans = {r[0]: r[-1] for r in found[64][0]}
    for (doc, text), (_, clean) in zip(rows, found[64][1]):
        out, at = "", 0
        for kind, a, b in (s.split(":") for s in spans[doc].split(",") if s):
            if int(a) >= at:
                out += text[at : int(a)] + f"[{kind.upper()}]"
            at = max(at, int(b))
        assert clean == out + text[at:]


def test_added_spans_hold_precision_and_recall(spark):
    """Forms that the base patterns don't know, among numbers that are no personal data."""
    rng = random.Random(12)
    names, hosts = ["anna", "j.doe", "max_m", "k-lee", "info", "sales"], ["mail.example.com", "gmail.com", "web.de", "outlook.com", "gmx.net"]

    def digits(n):
        return "".join(rng.choice("0123456789") for _ in range(n))

    def mail():
        name, (host, _, end) = rng.choice(names), rng.choice(hosts).rpartition(".")
        return rng.choice([f"{name}{k} (at) {host}.{end}" if rng.random() < 0.5 else f"{name}{k}[at]{host}.{end}" for k in [rng.randint(1, 99)]])

    def phone():
        return rng.choice(["", "00"]) + f"49 {rng.randint(30, 99)}0 {digits(3)} {digits(4)}" if rng.random() < 0.5 else f"0044 20 {digits(4)} {digits(4)}"

    true = [("email", mail, ["write to", "e-mail", "contact"]), ("phone", phone, ["call", "phone", "tel", "mobile"])]
    false = [lambda: f"page {rng.randint(1, 400)}-{rng.randint(400, 900)}", lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}", lambda: f"isbn 978 {digits(1)} {digits(3)} {digits(4)} {digits(1)}",
             lambda: f"year 2019-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: "meet (at) noon sharp", lambda: f"table {digits(3)}"]
    rows, planted = [], set()
    for doc in range(600):
        text = ""
        for _ in range(rng.randint(1, 4)):
            if rng.random() < 0.5:
                kind, make, words_ = rng.choice(true)
                text += f"{rng.choice(words_)} "
                span = make()
                planted.add((doc, kind, len(text), len(text) + len(span)))
                text += span + " . "
            else:
                text += rng.choice(false)() + " , "
        rows.append((doc, text))
    found = set()
    for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found |= {(r.doc_id, k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)}
    assert len(found & planted) >= 0.9 * len(planted)
    assert len(found & planted) >= 0.9 * len(found)
