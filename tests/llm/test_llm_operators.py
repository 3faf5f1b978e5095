"""Each operator against its plain Python form, on the small table and on odd rows."""

from __future__ import annotations

import random
from collections import Counter

import llm_brute as brute
import numpy as np
import pytest
from llm_rows import LONG, ODD
from pyspark.sql import functions as F

from findlark.llm import (
    decontaminate, langid, lines, mixing, passages, pii, quality, simhash, substrings, warc,
)
from findlark.llm.graph import components


def same(found, expected):
    assert Counter(map(tuple, found)) == Counter(map(tuple, expected))


def spread(seed, count, vocabulary=4000):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


# --- exact substrings ---

BYTES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


@pytest.mark.parametrize("hot", [2048, 1])
def test_substrings_small_table(docs, texts, hot):
    found = substrings.deduplicate(docs, hot=hot).select(*BYTES).collect()
    same(found, brute.substrings(sorted(texts.items()), 100))


def test_substrings_odd_rows(odd, empty):
    same(substrings.deduplicate(odd).select(*BYTES).collect(), brute.substrings(ODD, 100))
    assert substrings.deduplicate(empty).count() == 0


def test_substrings_limits_and_overlaps(make):
    base = "".join(random.Random(1).choices("abcdefgh", k=400))
    rows = [(1, base[:150]), (2, base[50:149]), (3, base[50:150]), (4, base[60:300] + base[61:300]), (5, "ab" * 300),
            (6, "b" + "ab" * 60), (7, base[100:] + "é" * 200), (7, base[100:] + "é" * 200), (None, base)]
    for hot in (2048, 0):
        same(substrings.deduplicate(make(rows), hot=hot).select(*BYTES).collect(), brute.substrings(rows, 100))


def test_substrings_in_segments(make, monkeypatch):
    """Texts longer than what is scanned at once, and runs longer than a block."""
    rng = random.Random(6)
    base = "".join(rng.choices("abcd", k=3000))
    rows = [(1, base), (2, base[700:2600] + "xyz" * 300 + base[:900]), (3, base[1500:] + base[1500:]), (4, "q" * 2500)]
    monkeypatch.setattr(substrings, "SCAN_BYTES", 300)
    monkeypatch.setattr(substrings, "ORDER_BYTES", 300)
    monkeypatch.setattr(substrings, "RUN", 40)
    same(substrings.deduplicate(make(rows)).select(*BYTES).collect(), brute.substrings(rows, 100))


# --- personal data ---

HARD = [
    "a@b.c_d@e.f x@y.z.w a@b a.b@c..d", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1.2.3",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111", "+1 (377) 555-0271+49 30 1234567 +12",
    "é 😀 a@b.co 😀 +1234567890", "a" * 20000 + " " + "1" * 9000 + "." + "a.b-" * 9000, "x@" + "a." * 9000 + "b",
]
COUNTS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]


def test_pii(docs, texts, odd, empty, make):
    found = pii.personal_data(docs).select(*COUNTS).collect()
    same(found, [brute.base_pii(*row) for row in texts.items()])
    rows = [*ODD, *enumerate(HARD, 100)]
    same(pii.personal_data(make(rows)).select(*COUNTS).collect(), [brute.base_pii(*row) for row in rows])
    assert pii.personal_data(empty).count() == 0


def test_pii_added_spans(make):
    text = "tel 377-555-0271 IBAN DE89 3704 0044 0532 0130 00, 212-555-0100, GB82WEST12345698765433"
    row = pii.personal_data(make([(1, text)])).first()
    # the second number has no context near it, the last account number a wrong checksum
    assert [(s.kind, s.value) for s in row.found] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("local_phone", "377-555-0271")
    ]
    assert row.spans == ",".join(f"{s.kind}:{s.start}:{s.end}" for s in row.found)
    assert all(text[s.start : s.end] == s.value for s in row.found)


def test_pii_account_numbers_before_words(make):
    one, two, three = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947"
    other = "DZ580002100001113000000570"
    cases = [
        (f"{one} BIC COBADEFF", [one]), ("DE89370400440532013000 EUR 500", ["DE89370400440532013000"]),
        (f"{one} Bitte", [one]), (f"{one} {two}", [one, two]), (f"{three} {one} 12 34", [three, one]),
        (f"{one}00", []), (f"x{one}", []), (f"{one}a", []), (other, [other]), (f"{other} {two}", [other, two]),
        (f"DE00 3704 0044 0532 0130 00 {two} AB", [two]),
    ]
    found = {r.doc_id: r.found for r in pii.personal_data(make([(k, t) for k, (t, _) in enumerate(cases)])).collect()}
    assert [[s.value for s in found[k] if s.kind == "iban"] for k in range(len(cases))] == [v for _, v in cases]


# --- decontamination ---

ITEMS = [
    (1, "If Anna buys 5 apples for 3 dollars each, how much does Anna pay in Berlin?"),
    (2, "tiny item"),
    (3, "Say we meet Bob at 7 km from Rome and then Bob walks 7 km back home with Carl again."),
    (None, "an item without an id is not looked for at all"),
    (4, None),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_templates(make, items):
    rows = [
        (1, "Hello. If Mary buys 12 apples for 9 euros each, how much does Mary pay in Paris? ok"),
        (2, "x say we meet Tom at 3 km from Oslo and then Tom walks 3 km back home with Sue again."),
        (3, "x say we meet Tom at 3 km from Oslo and then Pia walks 5 km back home with Sue again."),
        (4, "If Anna buys apples, she pays in Berlin."), (5, ITEMS[2][1]), (5, ITEMS[2][1]), (None, ITEMS[0][1]), *ODD,
    ]
    found = decontaminate.leaks(make(rows), items).collect()
    # in 3 one name and one number meet two partners each
    same([(r.doc_id, r.item_id) for r in found], [(1, 1), (2, 3), (5, 3), (None, 1)])
    # an item's first word that the document has in lower case costs the windows over it
    assert all(r.share >= 0.9 and r.consistency == 1 for r in found)


def test_leaks_beside_other_fillings(make, items):
    """An exact copy and a filling anew in one document, in either order, and two fillings."""
    exact = ITEMS[0][1]
    one = "If Mary buys 12 apples for 9 euros each, how much does Mary pay in Paris?"
    two = "If Pia buys 7 apples for 2 cents each, how much does Pia pay in Oslo?"
    rows = [(1, f"{exact} {one}"), (2, f"x {one} and so on. {exact}"), (3, f"{one} {two}"), (4, f"{exact} {one} {two}")]
    found = decontaminate.leaks(make(rows), items).collect()
    same([(r.doc_id, r.item_id, r.consistency) for r in found], [(k, 1, 1.0) for k in (1, 2, 3, 4)])


def test_leaks_of_other_kinds(make, spark):
    """Names that begin sentences, of several words, other case, numbers as words, short items."""
    rows = [
        (1, "Tom has 3 apples and 2 pears. Tom gives 2 apples to Sue, so how many apples are left to Tom at the end?"),
        (2, "Name the largest planet"), (3, "2 + 2"), (4, "!?"),
    ]
    items = spark.createDataFrame(rows, "item_id long, text string")
    one = rows[0][1]
    docs = [
        (1, one), (2, one.replace("Tom", "Anna")), (3, one.lower()), (4, one.upper()),
        (5, one.replace("Tom", "Mary Jane Smith").replace("Sue", "Old Bob")),
        (6, one.replace("3 ", "three ").replace("2 ", "two ")), (7, f"So it goes. {one.replace('Tom', 'Pia').replace('2', '9')} Well."),
        (8, "Please NAME THE LARGEST PLANET now"), (9, "Name the largest moon or planet"), (10, "1 + 2 and 2 * 2, then 2 + 2."),
        (11, "Tom has 3 sisters and 2 brothers. They give 2 books to Sue, and so on until the end of the year."), (12, "!?"),
        (13, "He said that Tom and Sue left. " * 20),
    ]
    found = decontaminate.leaks(make(docs), items).collect()
    # figures between other signs are the same tokens: 2 * 2 is an occurrence of item 3
    same([(r.doc_id, r.item_id) for r in found], [*[(k, 1) for k in range(1, 8)], (8, 2), (10, 3)])
    assert all(r.share >= 0.8 and r.consistency >= 0.8 for r in found)


def test_no_tokenizer_below_the_candidates(docs, spark, sf_dir):
    """Spark must not ask all texts whether they have windows: no filter holds the tokenizer."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    own = decontaminate.readings(docs.select("doc_id", "text"), "doc_id", 5, [], False)
    plan = own.select("doc_id", F.explode_outer(F.array_distinct("w")).alias("hash")).where("hash is not null")
    for frame in (plan, decontaminate.leaks(docs, benchmark)):
        lines_ = frame._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert not any("Filter" in line and "regexp_replace" in line for line in lines_)


def test_leaks_small_table(docs, texts, spark, sf_dir, items, empty):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    held = {(i, r.item_id) for i, t in texts.items() for r in benchmark.collect() if r.text in (t or "")}
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert held <= found and len(found - held) <= 0.05 * len(held) + 1
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


# --- language ---


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs.withColumn("held_out", langid.is_held_out())).where("held_out")
    right = rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98 and rows.where("score < 0 or score > 1").isEmpty()


def test_language_odd_rows(odd, empty):
    found = langid.identify(odd)
    assert found.columns == [*odd.columns, "lang_pred", "score"] or found.columns[-2:] == ["lang_pred", "score"]
    by_id = {r.doc_id: r.lang_pred for r in found.where("doc_id is not null").collect()}
    assert [by_id[k] for k in (1, 2, 3, 10)] == ["und"] * 4 and by_id[4] == "en"
    assert found.count() == len(ODD)
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}


def test_profile_is_sum_of_bound_ngrams():
    space = langid.Space(256, 1)
    rows, has = langid.profiles(["Abcab, c", "", None, "12"], space, 3)
    expected = np.zeros(256)
    text = " abcab c "
    for k in range(len(text) - 2):
        a, b, c = (space.letter(ord(x)).astype(int) for x in text[k : k + 3])
        expected += np.roll(a, 2) * np.roll(b, 1) * c
    assert (rows[0] == expected).all() and list(has) == [True, False, False, False] and not rows[1:].any()


def test_profiles_do_not_depend_on_batches(monkeypatch):
    texts = ["".join(map(chr, range(0x4E00 + 40 * k, 0x4E00 + 40 * k + 300))) for k in range(20)]
    space = langid.Space(64, 1)
    whole = langid.profiles(texts, space, 3)[0]
    monkeypatch.setattr(langid, "BLOCK", 100)
    assert (np.stack([langid.profiles([t], space, 3)[0][0] for t in texts]) == whole).all()


# --- SimHash ---


def test_simhash(docs, texts, odd, empty):
    def shown(rows):
        hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
        return simhash.near_duplicates(rows).select("doc_id", hexed, "component_id").collect()

    same(shown(docs), brute.simhash(list(texts.items())))
    same(shown(odd), brute.simhash(ODD))
    assert shown(empty) == []


def test_representatives(odd, docs, texts):
    kept = [r.doc_id for r in simhash.representatives(docs).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute.simhash(list(texts.items()))})
    rows = simhash.representatives(odd)
    assert rows.columns == odd.columns
    groups = {f for _, f, _ in brute.simhash(ODD)}
    assert rows.count() <= len(groups) and rows.where("doc_id = 7").isEmpty()


@pytest.mark.parametrize("limit", [1024, 8, 1])
def test_trie_links(spark, limit):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(15):
            x = base
            for b in rng.sample(range(64), rng.randrange(7)):
                x ^= 1 << b
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    expected = brute.components(prints, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    root = {r.node: r.root for r in components(simhash.links(frame, 3, limit)).collect()}
    assert [root.get(p, p) for p in prints] == [prints[k] for k in expected]


def test_components_of_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 600), (600, 500), (7, 7)], "a long, b long")
    root = {r.node: r.root for r in components(edges).collect()}
    assert root == {**{k: 0 for k in range(201)}, 500: 500, 600: 500}
    assert components(edges.limit(0)).count() == 0


# --- passages ---


def test_passages(make):
    p, q = spread(1, 60), spread(2, 52)
    near = list(p)
    near[30] = "edit"
    cut = [
        (1, spread(3, 100) + p + spread(4, 30)), (2, p + spread(5, 200)), (3, spread(6, 300)),
        (4, spread(7, 40) + near + spread(8, 50)), (5, spread(9, 10) + q), (6, spread(10, 20) + [w.upper() for w in q]),
        (7, spread(11, 49)), (8, p[:40] + spread(12, 100)), (10, p),
    ]
    rows = [(i, " ".join(w)) for i, w in cut] + [(9, None), (11, "")]
    found = {r.doc_id: r for r in passages.near_passages(make(rows)).collect()}
    expected = brute.near_passages(rows, 50, 0.8)
    assert [found[i].class_id for i, _ in rows] == [rows[k][0] for k in expected]
    assert all((found[i].n_links > 0) == (found[i].n_passages > 0) for i, _ in rows)
    assert [tuple(s) for s in found[10].spans] == [(0, 60)] and found[3].spans == []


def test_passages_small_table(docs, texts):
    found = {r.doc_id: r.class_id for r in passages.near_passages(docs).collect()}
    seen = {}
    for i in sorted(texts):
        w = (texts[i] or "").lower().split()
        for k in range(len(w) - 49):
            # exact passages of fifty words may not be missed
            assert found[seen.setdefault(tuple(w[k : k + 50]), i)] == found[i]


def test_passages_hot_group(make):
    p = spread(20, 80)
    rows = [(k, " ".join(spread(100 + k, 30) + p + spread(500 + k, 30))) for k in range(150)]
    found = passages.near_passages(make(rows)).collect()
    assert {r.class_id for r in found} == {0} and sum(r.n_links for r in found) < 20 * len(rows)


@pytest.mark.parametrize("block", [1024, 2])
def test_passages_interleaved_families(make, monkeypatch, block):
    """Two families under one minimum-hash value, ids in turn, one short passage in all."""
    monkeypatch.setattr(passages, "BLOCK", block)

    def family(head, seed):
        # four texts whose one minimum lies in the words that both families begin with
        for tail in (spread(seed + k, 34) for k in range(100)):
            rows = [[*head, *tail[:20], f"{seed}x{k}", *tail[20:]] for k in range(4)]
            texts = [" ".join(w).encode() for w in rows]
            _, value, content, _, at, *_ = passages.windows_of(texts, passages.SHINGLE, 46, 1)
            if len(set(value.tolist())) == 1 and len(set(content.tolist())) == 4 and at[0] < 22:
                return value[0], rows
        return None, None

    heads = (spread(30 + k, 26) for k in range(100))
    one, two = next(f for f in ((family(h, 10_000), family(h, 20_000)) for h in heads) if f[0][1] and f[1][1])
    assert one[0] == two[0]
    rows = [(k, " ".join(w)) for k, w in enumerate(w for pair in zip(one[1], two[1]) for w in pair)]
    found = {r.doc_id: r for r in passages.near_passages(make(rows), functions=1).collect()}
    assert [found[i].class_id for i, _ in rows] == brute.near_passages(rows, 50, 0.8) == [0, 1] * 4
    assert all(r.n_links > 0 and r.n_words >= 50 for r in found.values())


def test_passages_beside_equal_ones(make):
    """Documents tied by an exact passage have a near-duplicate one elsewhere."""
    exact, near = spread(40, 60), spread(41, 60)
    edited = [*near[:30], "edit", *near[31:]]
    cut = [[*exact, *spread(42, 80), *near], [*spread(43, 70), *edited, *spread(44, 60), *exact]]
    found = {r.doc_id: r for r in passages.near_passages(make([(k, " ".join(w)) for k, w in enumerate(cut)])).collect()}
    for row, places in ((found[0], (0, 140)), (found[1], (190, 70))):
        spans = [(s.start, s.end) for s in row.spans]
        assert row.class_id == 0 and row.n_passages == 2
        # each passage is matched, up to a few words at its ends
        assert all(any(s <= p + 12 and e >= p + 48 for s, e in spans) for p in places), spans


def test_passages_windows_in_segments(monkeypatch):
    """More shingles than places fit into the low bits of a hash."""
    texts = [" ".join(spread(50, 3000)).encode(), b"short", " ".join(spread(51, 500)).encode()]
    # hashes keep the bits that the smaller places leave, so only minima that tie in them could differ
    whole = [x.tolist() for x in passages.windows_of(texts, 5, 46, 3)]
    monkeypatch.setattr(passages, "POSITION_BITS", 8)
    assert [x.tolist() for x in passages.windows_of(texts, 5, 46, 3)] == whole


def test_passages_odd_rows(odd, empty):
    found = {r.doc_id: r for r in passages.near_passages(odd).collect()}
    assert set(found) == {i for i, _ in ODD} and all(r.class_id == i for i, r in found.items())
    assert passages.near_passages(empty).count() == 0


# --- lines ---


def test_lines(docs, texts, odd, empty):
    found = lines.deduplicate(docs)
    assert found.columns == [*docs.columns, "lines_before", "lines_removed"]
    same(found.select("doc_id", "text").collect(), brute.line_dedup(list(texts.items())))
    same(lines.deduplicate(odd).select("doc_id", "text").collect(), brute.line_dedup(ODD))
    assert lines.deduplicate(empty).count() == 0


@pytest.mark.parametrize("length", [2, 3, 5, 12])
def test_shared_passages_of_few_lines(make, length):
    """Passages between foreign lines: all of the later copies' lines go, and nothing else."""
    rows, expected = [], {}
    for k in range(40):
        passage = [f"shared {k} line {n}" for n in range(length)]
        for copy in range(3):
            own = [f"own {k} {copy} {n}" for n in range(4 + copy)]
            text = own[: copy + 1] + passage + own[copy + 1 :]
            rows.append((3 * k + copy, "\n".join(text)))
            expected[3 * k + copy] = "\n".join(text if copy == 0 else own)
    found = {r.doc_id: r.text for r in lines.deduplicate(make(rows)).collect()}
    assert found == expected


def test_chunks_resist_shifts():
    body = [f"line {k} {k * k % 97}" for k in range(200)]
    for every in (1, 3):
        whole = {h for *_, h in lines.chunks("\n".join(body), 2, every)}
        shifted = {h for *_, h in lines.chunks("\n".join(["new first line", *body[:100], "inserted", *body[100:]]), 2, every)}
        # all but the pair the inserted line takes apart
        assert len(whole - shifted) <= 1 and 200 / every / 2 < len(whole) < 200
    assert lines.chunks("one line", 2, 1) == [] and lines.chunks("\n \n\t\n", 2, 1) == []


# --- WARC ---

PAGES = [
    (3, "u3", "x" * 200), (1, "u1", "x" * 200), (2, None, "short"), (5, "u5", "short"), (4, "u\r\n4", None),
    (None, "n", "x" * 200), (6, "é", "é\r\n\r\n" * 100), (6, "é", "é\r\n\r\n" * 100), (7, "7", ""), (8, "8", "y" * 100),
    (9, "9", "y" * 100), (10, "10", "z" * 99), (11, "11", "z" * 99), (12, "12", LONG),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, shard int")
    uri, manifest = warc.write_archives(pages, shard_bytes=1000, file_bytes=300)
    found = warc.read_archives(spark, uri, manifest)
    same(
        found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(),
        brute.warc([(i, html) for i, _, html in PAGES]),
    )
    same(found.select("page_id", "url").collect(), [(i, u) for i, u, _ in PAGES])
    files = manifest.collect()
    assert sum(r.records for r in files) == len(PAGES) and len(files) > 2
    assert all(r.bytes <= 300 or r.records == 1 for r in files)
    # a second run, on other partitions, writes the same files
    _, again = warc.write_archives(pages.repartition(5, "html"), shard_bytes=1000, file_bytes=300)
    same(again.collect(), files)


def test_warc_pages_without_payload_spread(spark):
    """Revisits and empty payloads fill shards by their headers."""
    rows = [(k, "u", None if k % 2 else "x" * 200) for k in range(100)]
    _, manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), shard_bytes=5000)
    assert manifest.agg(F.max("records")).first()[0] <= 11


def test_warc_empty_and_damaged(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    uri, manifest = warc.write_archives(none)
    assert manifest.count() == 0 and warc.read_archives(spark, uri, manifest).count() == 0
    row = {"page_id": 1, "url": "u", "payload": b"other", "payload_bytes": 5, "payload_digest": brute.sha(b"right"),
           "record_type": "response", "refers_to": None}
    (tmp_path / "bad.warc.gz").write_bytes(warc.member(warc.record(row, warc.DATE), 6))
    listed = spark.createDataFrame([(0, "bad.warc.gz", 1, 1, "")], warc.MANIFEST)
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_archives(spark, f"file://{tmp_path}", listed).collect()


def test_warc_records_are_plain_gzip_members(spark):
    import gzip

    from pyarrow import fs

    uri, manifest = warc.write_archives(spark.createDataFrame([(1, "http://x/", "<p>")], "page_id long, url string, html string"))
    files, root = fs.FileSystem.from_uri(uri)
    with files.open_input_file(f"{root}/{manifest.first().file}") as f:
        data = gzip.decompress(f.read())
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\n<p>\r\n\r\n")


# --- mixing ---


def check_mix(rows):
    total = sum(r.size for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets.values()) == pytest.approx(1.5 * total)
    order = sorted((s for s in targets if s is not None), key=lambda s: s.encode()) + [None] * (None in targets)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    open_ = {s: t / weight[s] for s, (size, t) in targets.items() if t < 2 * size * (1 - 1e-12)}
    # below their caps, sources share by weight; those at their caps would have got more
    assert max(open_.values(), default=0) <= min(open_.values(), default=0) * (1 + 1e-9) + 1e-9
    level = max(open_.values(), default=float("inf"))
    assert all(2 * size / weight[s] <= level * (1 + 1e-9) for s, (size, t) in targets.items() if s not in open_)
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    longest = max((r.size for r in rows), default=0)
    assert all(abs(taken[s] - t) <= longest + 1 for s, (_, t) in targets.items())
    assert sum(taken.values()) == int(1.5 * total)


def test_mixing(docs, odd, empty, texts):
    rows = mixing.mix(docs).collect()
    check_mix(rows)
    assert {r.doc_id: r.size for r in rows} == {i: len(brute.words(t)) for i, t in texts.items()}
    same(mixing.mix(docs.repartition(3, "text")).collect(), rows)
    found = mixing.mix(odd).collect()
    check_mix(found)
    same([(r.doc_id, r.size) for r in found], [(i, len(brute.words(t))) for i, t in ODD])
    assert mixing.mix(empty).count() == 0


# --- quality ---

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality(docs, texts, odd, empty):
    found = quality.judge(docs)
    same(found.select(*BASE).collect(), [brute.quality(*row) for row in texts.items()])
    same(quality.judge(odd).select(*BASE).collect(), [brute.quality(*row) for row in ODD])
    assert quality.judge(empty).count() == 0
    assert found.where("base_failed and kept").isEmpty()


def test_quality_exact_beside_hashes(make, monkeypatch):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices("abc", k=rng.randrange(80)))) for k in range(60)]
    expected = [brute.quality(*row) for row in rows]
    same(quality.judge(make(rows)).select(*BASE).collect(), expected)
    # so few hash bits that different windows clash, and then texts that are too long for the packing
    for bits in (62, 3):
        monkeypatch.setattr(quality, "POSITION_BITS", bits)
        same(quality.judge(make(rows)).select(*BASE).collect(), expected)


def test_quality_divergence(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("not base_failed")
    assert rows.where("quality = 1 and not kept").isEmpty()
    assert not rows.where("quality = 0 and not kept").isEmpty()


def test_distance(spark):
    row = spark.range(1).select(
        quality.distance(F.array(F.lit(1), F.lit(1)), F.array(F.lit(5), F.lit(5))).alias("same"),
        quality.distance(F.array(F.lit(1), F.lit(0)), F.array(F.lit(0), F.lit(2))).alias("apart"),
        quality.distance(F.array(F.lit(0), F.lit(0)), F.array(F.lit(0), F.lit(2))).alias("none"),
    ).first()
    assert row.same == 0 and row.apart == pytest.approx(1) and row.none is None
