"""Text operators on awkward rows and against plain versions."""

import random
import time
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import archives, chat, common, decontamination, exact_dedup, language, mixing, near_dedup, pii, queries, sharding, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    """Nulls, empty and long texts, ties, repeated rows, exact and near copies, a hot group."""
    rng = random.Random(7)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words(rng, rng.randrange(1, 120))), "en", f"s{i % 4}", 1))
    base = words(rng, 150)
    for i in range(60, 110):
        w = list(base)
        w[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(w), "en", "s0", 1))
    rows += [(i, "The same text again!", "en", "s0", 1) for i in range(110, 170)]
    rows += [(170, None, None, None, None), (171, "", None, "s9", 0), (172, "", "en", None, 0), (173, "  \t\n", "en", "s1", 4), (174, "!!! ???", "en", "s1", 7)]
    rows += [(175, " ".join(words(rng, 20000)), "en", "s1", 1), (176, "a" * 50000, "en", "s2", 1)]
    rows += [(3, rows[3][1], "en", "s3", 1), (3, rows[3][1], "en", "s3", 1)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    df = spark.createDataFrame(corpus(), DOC).withColumn("extra", F.lit(1))
    return common.materialise(df, "test-docs")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def sized(df):
    return df.withColumn("size", sharding.byte_size(F.col("text")))


def test_shards_are_even_and_gapless(docs):
    rows = sharding.shard(sized(docs), F.col("size"), F.col("text"), F.col("doc_id"), shards=4).collect()
    assert len(rows) == len(corpus())
    total, by = sum(r.size for r in rows), {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    largest = max(r.size for r in rows)
    for mine in by.values():
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 4) <= 1.02 * largest
    again = sharding.shard(sized(docs), F.col("size"), F.col("text"), F.col("doc_id"), shards=4).collect()
    assert sorted((r.shard, r.slot, r.doc_id or 0) for r in again) == sorted((r.shard, r.slot, r.doc_id or 0) for r in rows)


def test_shards_of_nothing(empty):
    assert sharding.shard(sized(empty), F.col("size"), F.col("text"), F.col("doc_id")).count() == 0


CLASHES = ("row", "_g", "_size", "_key", "_src", "_d", "_t", "_id", "_th", "base", "wide", "digest", "shard", "slot", "target", "copies", "lang_pred", "h", "k")


@pytest.fixture(scope="session")
def clashing(docs):
    """docs with columns named like the operators' own."""
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


def kept_columns(out, *results):
    rows = out.select(*[c for c in CLASHES if c not in results]).distinct().collect()
    return len(rows) == 1 and all(rows[0][c] == f"own {c}" for c in CLASHES if c not in results)


def test_columns_of_the_input_are_returned(spark, clashing):
    own = clashing.where("doc_id < 40").withColumns({"size": common.count_words(F.col("text")), "weight": F.lit(1.0)})
    n = own.count()
    out = sharding.shard(own, F.col("size"), F.col("text"), F.col("doc_id"), shards=3)
    assert kept_columns(out, "shard", "slot") and out.count() == n
    assert kept_columns(mixing.mix(own), "target", "copies") and kept_columns(mixing.quality_weight(own, spark.createDataFrame([(1, 1)], "doc_id long, quality int")))
    none = spark.createDataFrame([(0, "zz")], "item_id long, text string")
    assert kept_columns(decontamination.decontaminate(own, none)) and kept_columns(near_dedup.dedup(own))
    assert kept_columns(pii.redact(own, pii.grow([]))) and kept_columns(language.predict(own, None), "lang_pred")
    assert exact_dedup.dedup(own).count() == n and near_dedup.classes(own).count() == n


def test_shards_of_one_repeated_row(spark):
    df = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")).withColumn("size", F.lit(8))
    rows = sharding.shard(df, F.col("size"), F.col("text"), F.col("doc_id"), shards=4).groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last")).collect()
    assert len(rows) == 4 and all(r.n == r.slots == r.last + 1 and abs(r.n - 750) <= 2 for r in rows)


def test_shards_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_sampled_splitters"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.text_crc32 == (zlib.crc32(texts[r.doc_id].encode()) if texts[r.doc_id] is not None else None) for r in rows)
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    even = sum(r.size for r in rows) / 24
    assert all(sorted(r.slot for r in mine) == list(range(len(mine))) and abs(sum(r.size for r in mine) - even) <= 1.02 * max(r.size for r in rows) for mine in shards.values())
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 200, "c": 30, None: 5}, {"a": 1, "b": 1}, {"a": 0, "b": 7}, {"a": 5}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, 1, n) for s, n in sizes.items()], "source string, n long, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute.targets(sizes))


def test_mix_comes_near_its_targets(docs):
    df = docs.withColumn("size", common.count_words(F.col("text"))).withColumn("weight", F.lit(1.0))
    rows = mixing.mix(df).collect()
    assert len(rows) == len(corpus()) and all(r.copies <= 3 for r in rows)
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        assert r.size == brute.size_words(r.text)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = brute.targets(sizes)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert sorted((r.doc_id or 0, r.copies) for r in mixing.mix(df).collect()) == sorted((r.doc_id or 0, r.copies) for r in rows)


def test_mix_of_repeated_rows_and_weights(spark):
    """A row that is a third of its source is taken in part; good documents are taken before bad ones."""
    rows = [(7, "a", 10, 1.0)] * 600 + [(100 + i, "a", 10, 4.0 if i % 2 else 0.25) for i in range(1200)] + [(5000 + i, "b", 10, 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, weight double")
    out = mixing.mix(df, cycle=(1, 2)).collect()
    want = brute.targets({"a": 18000, "b": 2000}, (1, 2))
    for s in want:
        assert abs(sum(r.size * r.copies for r in out if r.source == s) - want[s]) <= 10
    taken = [sum(r.copies for r in out if r.source == "a" and r.weight == w) for w in (4.0, 0.25)]
    assert taken[0] > taken[1]


def test_mix_of_nothing(empty):
    assert mixing.mix(empty.withColumn("size", F.lit(1)).withColumn("weight", F.lit(1.0))).count() == 0


PII_CASES = ["a@b.c@d.e x a@b..c", "1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4", "4111 1111-1111 1111 and 4111111111111111 4111  1111", "+1 (988) 555-0546+44 20 7946 0958.", None, "", "é𝒳 a@b.co 𝒳 +1 (988) 555-0546", "1 " * 3000, "a@b" + ".c" * 3000, "9" * 3000]


def test_base_rules(spark):
    df = spark.createDataFrame(list(enumerate(PII_CASES)), "doc_id long, text string")
    found = common.materialise(pii.candidates(df).drop("text"), "test-pii")
    out = pii.detect(found, pii.fit(found)).select("doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.concat("base", "added")).alias("spans"))
    for r in out.collect():
        assert r.base == brute.pii(PII_CASES[r.doc_id])
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))


def test_trees_add_what_looks_like_base_spans(spark):
    texts = [f"please call +1 ({200 + i}) 555-{1000 + i} now" for i in range(80)] + ["please call (988) 555-0546 now", "the year 2024 had 366 days"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.candidates(df)
    out = {r.doc_id: r.added for r in pii.detect(found, pii.fit(found)).collect()}
    assert [(s["name"], s["start"]) for s in out[80]] == [("phone", 12)] and not out[81]
    assert "[phone]" in pii.redact(df.where("doc_id = 0"), pii.fit(found)).first().redacted


PII_FORMS = {
    "email": ["a@b.co", "a @ b", "a(at)b(dot)co", "a [at] b [dot] co"], "ip": ["10.0.0.1", "10[.]0[.]0[.]1", "10 . 0 . 0 . 1", "10[.]0.0 . 1"],
    "card": ["411111111111", "4111 1111 1111 1111", "4111.1111_1111/1111", "4111-1111-1111-1111"], "phone": ["+1 988 555 0546", "(988) -(555)", "0049 30 123456", "(988) 555-0546", "988.555.0546", "988/555", "(988)-(555)", "988- (555)"],
}


def test_hints_let_every_form_through(spark):
    df = spark.createDataFrame([(f"see {x} now",) for forms in PII_FORMS.values() for x in forms], "text string")
    for patterns in (pii.BASE, pii.WIDE):
        kinds = [k for k in PII_FORMS if k != "card" or patterns is pii.WIDE]
        wanted = {f"{k}_{n}": (patterns[k], hint) for k in kinds for n, hint in (("hinted", pii.HINTS[k]), ("all", ""))}
        for r in pii._spans(df, "text", wanted).collect():
            assert all(r[f"{k}_hinted"] == r[f"{k}_all"] for k in kinds), r.text
            assert patterns is pii.BASE or any(r[f"{k}_all"] for k in kinds)


def planted(rng, n):
    """Texts of words without digits and one thing each: (text, kind and place of what must be found or None)."""
    out = []
    plain = lambda k: " ".join("".join(rng.choice("aeionrst") for _ in range(5)) for _ in range(k))
    luhn = lambda d: next(d + str(x) for x in range(10) if brute.luhn(d + str(x)))
    for i in range(n):
        digits = luhn("4" + "".join(rng.choice("0123456789") for _ in range(14)))
        name = f"u{rng.randrange(999)}"
        ip = [rng.randrange(1, 255) for _ in range(4)]
        forms = [
            ("email", f"{name}@mail{i % 7}.example.com"), ("email", f"{name} (at) mail (dot) example (dot) com"), ("email", f"{name}[at]mail.example.com"), ("ip", ".".join(map(str, ip))), ("ip", "[.]".join(map(str, ip))), ("card", digits), ("card", ".".join(digits[j : j + 4] for j in (0, 4, 8, 12))),
            ("phone", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"), ("phone", f"0044 20 {rng.randrange(1000, 9999)} {rng.randrange(1000, 9999)}"), ("secret", "".join(rng.choice("0123456789abcdef") for _ in range(40))),
            (None, "the year 2024"), (None, "version 1.2.3"), (None, str(rng.randrange(10**15, 10**16))), (None, "pages 12-14 and 20"), (None, "x" * 30),
        ]
        kind, form = forms[i % len(forms)]
        lead = plain(8) + {"secret": " token = "}.get(kind, " ")
        out.append((f"{lead}{form} {plain(5)}", kind and f"{kind}:{len(lead)}:{len(lead) + len(form)}"))
    return out


def test_planted_spans(spark):
    cases = planted(random.Random(23), 900)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    found = common.materialise(pii.candidates(df).drop("text"), "test-planted")
    trees = pii.fit(found)
    got = {r.doc_id: set(filter(None, r.spans.split(","))) for r in pii.detect(found, trees).select("doc_id", pii.listed(F.concat("base", "added")).alias("spans")).collect()}
    real = [i for i, (_, x) in enumerate(cases) if x]
    right = sum(cases[i][1] in got[i] for i in real)
    claimed = sum(len(got[i]) for i in got)
    missed = {cases[i][0] for i in real if cases[i][1] not in got[i]}
    assert right >= 0.9 * len(real) and right >= 0.9 * claimed, (right, len(real), claimed, sorted(missed)[:8])


def test_trees_refuse_look_alikes(spark):
    """Order numbers in a form of their own pass Luhn one time in ten; the trees tell them from cards, the check alone does not."""
    rng, texts, orders = random.Random(43), [], []
    for i in range(600):
        digits = "".join(rng.choice("0123456789") for _ in range(16))
        groups = [digits[j : j + 4] for j in (0, 4, 8, 12)]
        card = next("4" + digits[:14] + str(x) for x in range(10) if brute.luhn("4" + digits[:14] + str(x)))
        texts += [f"order {'/'.join(groups)} of item {'abcdef'[i % 6]}", f"pay by card {'.'.join(card[j : j + 4] for j in (0, 4, 8, 12))} now, {'abcdef'[i % 6]}"]
        orders += [len(texts) - 2] if brute.luhn(digits) else []
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = common.materialise(pii.candidates(df).drop("text"), "test-look-alikes")
    trees = pii.fit(found)
    added = lambda t: {r.doc_id for r in pii.detect(found, t).where(F.size("added") > 0).select("doc_id").collect()}
    with_trees, without = added(trees), added(pii.Trees(0.0, [], [0.0] * 5))
    assert len(orders) > 30 and set(orders) <= without and not set(orders) & with_trees
    assert sum(d % 2 for d in with_trees) > 0.95 * 600


@pytest.mark.parametrize("n", [20, 200, 201, 5000])
def test_tokens_of_any_length(spark, n):
    token = ("a1B2" * n)[:n]
    row = pii.candidates(spark.createDataFrame([(f"key {token} end",)], "text string")).first()
    assert [(c.name, c.start, c.end) for c in row.wide] == [("secret", 4, 4 + n)]


def test_spans_of_documents(spark, sf_dir):
    """All spans of the table against a plain version with the same trees."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = common.materialise(pii.candidates(docs.select("doc_id", "text")).drop("text"), "test-spans")
    trees = pii.fit(found)
    got = {r.doc_id: r for r in pii.detect(found, trees).select("doc_id", pii.listed(F.col("base")).alias("base"), pii.listed(F.col("added")).alias("added")).collect()}
    for r in docs.collect():
        assert got[r.doc_id].base == brute.pii(r.text) and got[r.doc_id].added == ",".join(brute.added(r.text, trees)), r.doc_id
    assert sum(bool(r.added) for r in got.values()) > 5


def test_many_matches_in_one_text(spark):
    text = " ".join(f"a{i}@b.co or c{i}(at)d.co" for i in range(8000))
    df = spark.createDataFrame([(1, text), (1, text), (2, None)], "doc_id long, text string")
    began = time.time()
    found = common.materialise(pii.candidates(df), "test-many")
    rows = pii.detect(found, pii.Trees(0.0, [], [0.0] * 5)).select("doc_id", F.size("base").alias("n"), F.size("added").alias("m")).collect()
    assert sorted((r.doc_id, r.n, r.m) for r in rows) == [(1, 8000, 8000), (1, 8000, 8000), (2, 0, 0)] and time.time() - began < 60


def test_pii_of_nothing(empty):
    found = pii.candidates(empty)
    assert pii.detect(found, pii.fit(found)).count() == 0


def test_archives_round_trip(spark):
    big = "é" * 60
    rows = [(1, "http://a", big), (2, "http://b", big), (3, None, None), (4, "http://d", "short"), (5, "http://e", "short"), (6, "http://f g", "x" * 200 + "\r\n\r\nWARC/1.1\r\n" + "y" * 50), (None, "http://n", big), (7, "http://z", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for compress in (True, False):
        arc, warc = common.scratch(spark, "test-arc"), common.scratch(spark, "test-warc")
        archives.write_arc(pages, arc, "page_id", "url", "html", compress=compress)
        read = archives.read_arc(spark, f"{arc}/*")
        assert sorted((r.key or "", bytes(r.payload).decode()) for r in read.collect()) == sorted((str(i or ""), h or "") for i, _, h in rows)
        archives.write_warc(archives.convert(read), warc, compress)
        got = {r.key: r for r in archives.read_warc(spark, warc).collect()}
        assert {k: (r.record_type, r.refers_to_key) for k, r in got.items()} == {"1": ("response", None), "2": ("revisit", "1"), "": ("revisit", "1"), "3": ("response", None), "4": ("response", None), "5": ("response", None), "6": ("response", None), "7": ("response", None)}
        assert all(got[str(i or "")].payload_bytes == len((h or "").encode()) and got[str(i or "")].payload_digest == brute.sha(h or "") for i, _, h in rows)
        assert got["2"].refers_to == got["1"].record_id


def test_truncated_archive():
    block = b"1 0 x\nURL IP-address Archive-date Content-type Archive-length\n"
    data = b"filedesc://x 0.0.0.0 20240101000000 text/plain %d\n%s\nhttp://a 0.0.0.0 20240101000000 text/html 10\nabc" % (len(block), block)
    with pytest.raises(ValueError, match="early"):
        list(archives.parse_arc(data))


def decontamination_case():
    rng = random.Random(3)
    items = [(i, " ".join(words(rng, n, 5000))) for i, n in enumerate((30, 10, 12, 40, 9, 3, 1))] + [(7, None), (8, "..."), (9, None)]
    items[9] = (9, items[0][1].upper())
    docs = [(i, " ".join(words(rng, 60, 5000))) for i in range(20)]
    cut = lambda k, a, b: items[k][1].split()[a:b]
    docs += [(20, " ".join([*words(rng, 20, 5000), *cut(0, 5, 20), *words(rng, 9, 5000)])), (21, " ".join(cut(0, 0, 9))), (22, items[4][1] + "!"), (23, "x, " + items[6][1]), (24, " ".join(cut(3, 0, 10) + ["zz"] + cut(3, 10, 40))), (25, None), (26, ""), (27, items[1][1]), (28, " ".join(["aaa"] * 500)), (20, "other")]
    items.append((10, " ".join(["aaa"] * 14)))
    return docs, items


def test_winnowing_finds_every_window(spark):
    docs, items = decontamination_case()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (decontamination.BLOCK, 20):
        spans, _ = decontamination.spans(d, b, block=block)
        assert spans.count() > 0
    got = {(r._d, r._t): r for r in decontamination.contaminated_words(d, b).collect()}
    texts = d.select("doc_id", "text", *decontamination.row_key()).collect()
    for r in texts:
        n, hit, found = brute.contaminated([(0, r.text)], items)[0]
        mine = got.get((r._d, r._t))
        assert (mine.n_hit if mine else 0, mine.items_sha256 if mine else brute.sha("")) == (hit, brute.sha(",".join(found))), r
    kept = {(r.doc_id, r.text) for r in decontamination.decontaminate(d, b).collect()}
    assert kept == {x for x in docs if not brute.contaminated([x], items)[x[0]][1]}


def test_winnowing_of_long_and_repeated_texts(spark):
    rng = random.Random(29)
    item = words(rng, 20, 5000)
    long = words(rng, 200_000, 5000) + item + words(rng, 200_000, 5000)
    df = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(item)), (2, " ".join(item)), (2, "other"), (None, " ".join(item))], "doc_id long, text string")
    began = time.time()
    got = {(r._d, r._t): r.n_hit for r in decontamination.contaminated_words(df, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()}
    assert len(got) == 3 and set(got.values()) == {20} and time.time() - began < 60
    assert [r.text for r in decontamination.decontaminate(df, spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")).collect()] == ["other"]


def test_no_items(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(docs, none).count() == docs.count()
    assert decontamination.contaminated_words(docs.limit(0), none).count() == 0


def check_dedup(rows, out):
    norm = lambda t: __import__("re").sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for r in rows:
        groups.setdefault(norm(r[1]), []).append(r[0])
    want = sorted((r[0], min(groups[norm(r[1])]), len(groups[norm(r[1])]), r[0] == min(groups[norm(r[1])]), brute.sha(norm(r[1]))) for r in rows)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out.collect()) == want


def test_stream_dedup(docs):
    check_dedup(corpus(), exact_dedup.dedup(docs))
    check_dedup(corpus(), exact_dedup.dedup(docs.repartition(5), files_per_batch=2))


def test_equal_digests_of_different_texts(docs):
    check_dedup(corpus(), exact_dedup.dedup(docs, digest=lambda c: F.to_binary(F.lpad(F.hex(F.crc32(c) % 7), 8, "0"), F.lit("hex"))))


def test_stream_dedup_of_nothing(empty):
    assert exact_dedup.dedup(empty).count() == 0


def test_near_classes(docs):
    rows = corpus()
    out = near_dedup.classes(docs)
    got = {(r._id, r._node): r for r in out.collect()}
    want = brute.near_classes(list({d: (d, t) for d, t, *_ in rows}.values()))
    assert out.count() == len(rows) and {r._id: r.class_id for r in got.values()} == want
    kept = near_dedup.dedup(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id for r in kept} == set(want.values())


def test_near_classes_of_many_families(spark):
    rng = random.Random(5)
    passage, rows = words(rng, 60), []
    for family in range(12):
        base = words(rng, 20, 9000) + passage + words(rng, 20, 9000)
        for k in range(6):
            w = list(base)
            w[rng.randrange(len(w))] = f"x{family}{k}"
            rows.append((len(rows), " ".join(w)))
    out = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r._id: r.class_id for r in out} == brute.near_classes(rows)


def edited(rng, text, share):
    """The words of text with every so many of them replaced, so that about this share of the five-word shingles is lost."""
    out, step = list(text), round(5 / share)
    for k in range(rng.randrange(step), len(out), step):
        out[k] = f"v{rng.randrange(10**9)}"
    return out


def bridged(rng, groups):
    """Groups of near copies of a base; of two more texts that are similar, one only is similar to the base."""
    rows = []
    for _ in range(groups):
        base = words(rng, 200, 9000)
        bridge = edited(rng, base, 0.1)
        texts = [edited(rng, base, 0.025) for _ in range(20)] + [bridge, edited(rng, bridge, 0.1)]
        rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate(texts)]
    return rows


def drifting(rng, versions):
    """Versions of a text, each with one word of the one before replaced."""
    w, rows = words(rng, 300, 9000), []
    for k in range(versions):
        w[k * 37 % 300] = f"v{rng.randrange(10**9)}"
        rows.append((k, " ".join(w)))
    return rows


@pytest.mark.parametrize("make", [lambda rng: bridged(rng, 8), lambda rng: drifting(rng, 200)], ids=["bridged", "drifting"])
def test_near_classes_reach_past_the_centre(spark, make):
    rows = make(random.Random(13))
    out = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r._id: r.class_id for r in out} == brute.near_classes(rows)


def test_near_classes_lose_no_pair_of_a_large_bucket(spark, monkeypatch):
    """Similar texts among many that share a passage, with few sketches, so that pairs have few buckets, nearly all of them large."""
    sketch = near_dedup._sketch
    monkeypatch.setattr(near_dedup, "_sketch", lambda c: F.slice(sketch(c), 1, 4))
    monkeypatch.setattr(near_dedup, "SKETCHES", 4)
    rng = random.Random(17)
    passage, rows = words(rng, 170, 9000), []
    for i in range(0, 160, 2):
        own = passage + words(rng, 30, 9000)
        rows += [(i, " ".join(own)), (i + 1, " ".join(edited(rng, own, 0.1)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    shared = {r._id: set(enumerate(r.s)) for r in near_dedup._hashed(df, "text", "doc_id").select("_id", near_dedup._sketch("h").alias("s")).collect()}
    got = {r._id: r.class_id for r in near_dedup.classes(df).collect()}
    similar = [i for i in range(0, 160, 2) if shared[i] & shared[i + 1] and brute.near_classes(rows[i : i + 2])[i + 1] == i]
    lost = [i for i in similar if got[i] != got[i + 1]]
    assert len(similar) > 40 and not lost, f"{len(lost)} of {len(similar)} lost"


def test_near_classes_of_short_texts(spark):
    """Pairs of 5 to 15 words and of some more: one or two words added at an end, or the first or a word near the end replaced."""
    rng, rows = random.Random(19), []
    for n in [*range(5, 16), 20, 24, 25, 29, 30, 33]:
        for _ in range(12):
            w = words(rng, n, 10**6)
            for other in (w, ["new", *w[1:]], [*w[:-1], "new"]):
                rows.append((len(rows), " ".join(other)))
            for more in (1, 2, 3):
                w = words(rng, n, 10**6)
                rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(w + words(rng, more, 10**6)))]
                w = words(rng, n, 10**6)
                rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(words(rng, more, 10**6) + w))]
    out = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got, want = {r._id: r.class_id for r in out}, brute.near_classes(rows)
    assert not {i: want[i] for i in want if got[i] != want[i]}


def test_near_links(spark):
    """Classes and links against all pairs by alignment: an edited text, one with its halves exchanged, copies."""
    rng, rows = random.Random(31), []
    for _ in range(25):
        w = words(rng, 120, 9000)
        rows += [" ".join(w), " ".join(edited(rng, w, 0.05)), " ".join(w[60:] + w[:60]), " ".join(w)]
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_node", F.lit("x"))
    assert_links(df, rows)


def assert_links(df, rows):
    """Classes, and the number of different texts that each is linked to."""
    want = brute.near_links(rows)
    assert {r._id: r.class_id for r in near_dedup.classes(df).collect()} == {d: c for d, (c, _) in want.items()}
    n = Counter()
    for a, b in near_dedup.links(df).collect():
        n[a] += 1
        n[b] += 1
    first = {}
    for d, t in rows:
        first.setdefault(t, d)
    assert {d: n[first[t]] for d, t in rows} == {d: k for d, (_, k) in want.items()}


def test_links_of_families_of_any_size(spark):
    """Copies of a text with one word replaced each: all are similar to all."""
    rng, rows = random.Random(37), []
    for size in (8, 9, 12, 50, 300):
        base = words(rng, 120, 9000)
        for k in range(size):
            w = list(base)
            w[k * 7 % 120] = f"x{size}y{k}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n, sizes, at = Counter(), (8, 9, 12, 50, 300), 0
    for a, b in near_dedup.links(df).collect():
        n[a] += 1
        n[b] += 1
    classes = {r._id: r.class_id for r in near_dedup.classes(df).collect()}
    for size in sizes:
        own = range(at, at + size)
        assert {classes[i] for i in own} == {at} and {n[i] for i in own} == {size - 1}, size
        at += size


def test_reordered_texts_make_few_candidates(spark, monkeypatch):
    """The same twelve sentences in other orders have nearly the same shingles, but do not align; about 1 % of pairs have the marks of two texts in order by chance."""
    rng = random.Random(41)
    sentences = [words(rng, 30, 9000) for _ in range(12)]
    made, remaining = [], near_dedup._remaining
    monkeypatch.setattr(near_dedup, "_remaining", lambda *x: made.append((out := remaining(*x)).count()) or out)
    for n in (200, 400):
        texts = [" ".join(w for s in rng.sample(sentences, 12) for w in s) for _ in range(n)]
        texts[-1] = texts[0].replace(texts[0].split()[100], "other")
        out = near_dedup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        assert {r._id: r.class_id for r in out}[n - 1] == 0
    assert all(m <= 0.015 * n * (n - 1) / 2 for m, n in zip(made, (200, 400), strict=True)), made


def test_recall_of_near_classes(spark):
    """Rows whose identifier is divisible by 20 against all rows: similar ones are in their class. Similar texts share shingles, so those are looked up first."""
    table = "/root/testdata/sf0.1/documents.parquet"
    docs = {r.doc_id: r.text for r in spark.read.parquet(table).collect()}
    got = {r._id: r.class_id for r in near_dedup.classes(spark.read.parquet(table)).collect()}
    asked = {d: set(brute.labelled(t)) for d, t in docs.items() if d % 20 == 0}
    holders = {}
    for d, own in asked.items():
        for x in own:
            holders.setdefault(x, []).append(d)
    pairs = []
    for d, t in docs.items():
        own = set(brute.labelled(t))
        both = Counter(a for x in own for a in holders.get(x, ()))
        pairs += [(a, d) for a, n in both.items() if a != d and n / (len(own) + len(asked[a]) - n) >= 0.8 and brute.aligned(t, docs[a]) >= 0.8]
    right = sum(got[a] == got[b] for a, b in pairs)
    assert len(pairs) > 50 and right >= 0.99 * len(pairs), (right, len(pairs))


def test_near_classes_of_nothing(empty):
    assert near_dedup.classes(empty).count() == 0 and near_dedup.dedup(empty).count() == 0


def test_alignment():
    import numpy as np

    a = np.arange(100, dtype=np.int32)
    assert near_dedup.alignment(a, a) == 1.0 and near_dedup.alignment(a, a[::-1].copy()) == 0.0
    assert near_dedup.alignment(a, a[5:]) == pytest.approx(0.95) and near_dedup.alignment(a, a[:70]) == 0.0


TURNS = "conv_id long, turn long, role string, text string"


def test_snapshots_collapse(spark):
    full = [("user", "hi"), ("assistant", "hello"), ("user", None), ("assistant", "ok")]
    rows = [(c, t, r, x) for c, n in ((1, 2), (2, 4), (3, 4), (4, 3)) for t, (r, x) in enumerate(full[:n])]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, 0, None, None), (7, 3, "user", "b"), (7, 1, "user", "a"), (None, 0, "user", "z"), (8, 0, "user", "hi")]
    out = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, TURNS).withColumn("extra", F.lit(0))).collect()}
    assert set(out) == {2, 5, 6, 7, None} and out[2].copies == 2 and out[2].n_turns == 4
    assert out[7].chat == "<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n" and out[6].chat == "<|im_start|>\n<|im_end|>\n"
    assert chat.render(spark.createDataFrame([], TURNS)).count() == 0


def test_a_null_conversation_is_not_an_empty_one(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in (None, "", "7") for t in (0, 1)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").withColumn("n_turns", F.lit("own"))
    got = {r.conv_id: (r.n_turns, r.copies) for r in chat.render(df).collect()}
    assert got == {None: (2, 1), "": (2, 1), "7": (2, 1)}
    assert chat.render(df.limit(0)).count() == 0


def test_snapshots_with_repeated_and_long_turns(spark):
    long = "x" * 300_000
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", long), (3, 1, "assistant", long)]
    out = {r.conv_id: r for r in chat.render(spark.createDataFrame(rows, TURNS)).collect()}
    assert set(out) == {1, 3} and out[1].n_turns == 2 and len(out[3].chat) > 600_000


def test_toxicity_of_nothing_and_of_repeated_rows(spark):
    d = spark.createDataFrame([(1, "vile words here")] * 400 + [(2, "kind words here"), (2, "other words"), (None, "null"), (3, None)], "doc_id long, text string")
    y = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert not toxicity.fit(d.limit(0), y).any()
    w = toxicity.fit(d, y)
    assert (w == toxicity.fit(d.distinct(), y)).all()
    assert d.select(toxicity.score(d, w).alias("s")).where("s between 0 and 1").count() == d.count()


def test_toxicity_against_a_plain_fit(spark, sf_dir):
    """Weights and scores on labelled rows of the table against FTRL-proximal in plain Python."""
    import math

    import numpy as np

    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    w = toxicity.fit(docs, labels)
    y = {r.doc_id: int(r.toxic > 0) for r in labels.where("toxic is not null").collect()}
    rows = docs.select("doc_id", F.xxhash64("doc_id", F.lit(3)).alias("o"), F.transform(common.words(F.lower(F.col("text"))), lambda x: F.xxhash64(x)).alias("h")).collect()
    sample = [(list(zip(*(v.tolist() for v in toxicity.features(np.array(r.h, dtype=np.int64))), strict=True)), y[r.doc_id]) for r in sorted(rows, key=lambda r: (r.o, r.doc_id)) if r.doc_id in y]
    seen = Counter(i for x, _ in sample for i in {i for i, _ in x})
    z, n = Counter(), Counter()
    weight = lambda i: 0.0 if abs(z[i]) <= toxicity.L1 else (math.copysign(toxicity.L1, z[i]) - z[i]) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA)
    for _ in range(toxicity.PASSES):
        for x, label in sample:
            x = [(i, v) for i, v in x if i == 0 or seen[i] >= toxicity.SEEN]
            own = {i: (weight(i), z[i], n[i]) for i, _ in x}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(own[i][0] * v for i, v in x)))))
            for i, v in x:  # of a word and a pair with one coordinate the pair counts
                w0, z0, n0 = own[i]
                g = (p - label) * v
                z[i], n[i] = z0 + g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / toxicity.ALPHA * w0, n0 + g * g
    want = {i: weight(i) for i in n if weight(i)}
    assert set(want) == set(np.flatnonzero(w).tolist()) and all(abs(w[i] - v) < 1e-6 for i, v in want.items())


def test_toxicity_learns_words(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        rows.append((i, " ".join(words(rng, 30) + (["vile"] if bad else [])) if i < 298 else None))
        labels.append((i, int(bad)))
    labels += [(1, None), (None, 1)]
    d, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    w = toxicity.fit(d.where("doc_id < 200"), y)
    got = {r.doc_id: r.s for r in d.select("doc_id", toxicity.score(d, w).alias("s")).collect()}
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in range(200, 296)) >= 92
    assert 0 <= got[299] <= 1 and (w != 0).sum() < 200
    none = toxicity.fit(d, y.limit(0))
    assert d.select(toxicity.score(d, none).alias("s")).first().s == 0.5


LETTERS = {"aa": "abcdefgh", "zz": "stuvwxyz"}


def test_language(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice(LETTERS[k]) for _ in range(5)) for _ in range(40)), k) for i, k in enumerate(["aa", "zz"] * 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(d.where("doc_id < 80"))
    got = {r.doc_id: r for r in language.predict(d, model).collect()}
    assert all(got[i].lang_pred == k and not got[i].rejected for i, _, k in rows)
    odd = spark.createDataFrame([(0, None), (1, ""), (2, "123 !"), (3, "λόγος και τέχνη " * 30)], "doc_id long, text string")
    out = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].rejected for i in (0, 1, 2)) and out[3].lang_pred in ("aa", "zz") and out[3].rejected
    assert language.fit(d.limit(0)) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}


def test_language_of_null_and_repeated_identifiers(spark):
    rng = random.Random(4)
    text = lambda k: " ".join("".join(rng.choice(LETTERS[k]) for _ in range(5)) for _ in range(30))
    rows = [(None, text(k), k) for k in ["aa", "zz"] * 1500] + [(5, "abcdef " * 20, "aa")] * 3000
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(d)
    out = language.predict(d.distinct(), model).collect()
    assert model.langs == ["aa", "zz"] and all(r.lang_pred == r.lang for r in out)


def test_language_against_a_plain_comparison(spark):
    """Predictions and scores of the table against cosines in plain Python with the same model."""
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs)
    for r in language.predict(docs, model).collect():
        counts = language._counts(np.frombuffer((r.text or "").lower().encode(), dtype=np.uint8))
        if counts is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        v = [(c**0.5) * float(i) for c, i in zip(counts.tolist(), model.idf, strict=True)]
        norm = sum(x * x for x in v) ** 0.5
        cosines = [sum(x * float(y) for x, y in zip(v, c, strict=True) if x) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert abs(r.score - min(1, cosines[best])) < 1e-4 and r.lang_pred == model.langs[model.owner[best]]


def test_held_out_accuracy(spark):
    out = queries.QUERIES["op10_nearest_centroid"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    tox = queries.QUERIES["op9_ftrl"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    hit = [r for r in tox if r.predicted]
    assert sum(r.toxic for r in hit) >= 0.9 * len(hit) and len(hit) >= 0.6 * sum(r.toxic for r in tox)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(name, same_as_sql):
    same_as_sql(queries.QUERIES[name], queries.ORACLE_SQL[name])
