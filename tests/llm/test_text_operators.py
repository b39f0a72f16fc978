"""Operators on text columns against brute force, with the defined edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from patchloom.llm import decontamination, gif, license_scan, line_dedup, ngram_join, packing, suffix_dedup, warc
from patchloom.llm.queries import tokenizer_path
from tests_llm_tables import brute_components, brute_lines

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = ["alpha", "Beta", "gamma", "delta", "épée", "zeta", "eta", "theta", "iota", "kappa", "1999", "lam-bda"]


def corpus():
    draw = random.Random(5)
    text = lambda n: " ".join(draw.choice(WORDS) + (draw.choice("\n.,") if draw.random() < 0.2 else "") for _ in range(n))
    base = text(160)
    words = base.split(" ")
    rows = [(0, base), (1, base), (2, " ".join(words[:150])), (3, " ".join([*words[:80], "other", *words[81:]])), (4, text(160)), (5, ""), (6, None), (7, "one two"), (8, base[:300] + text(40)), (9, text(40) + base[100:400]), (10, "x" * 120), (11, "y" * 49), (12, "x" * 120), (13, text(3000)), (14, "\n\n\n\n"), (15, "tail é"), (16, "Hello, World!! 'tis <|endoftext|> 3.14")]
    return rows + [(20 + i, " ".join([*words[: 10 * i], *text(20).split(" ")])) for i in range(12)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    """Null and repeated ids, repeated rows, and columns named like the operators' own."""
    rows = [(None, "a b c d e f", 1, "p", "q"), (1, "a b c d e f", 2, "p", "q"), (1, "a b c d e f", 2, "p", "q"), (1, "other words of this row here", 3, "p", "q")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, tag bigint, spans string, later string")


def test_line_dedup(docs, rows, empty, clashing):
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup.line_report(docs).collect()}
    want = brute_lines(rows)
    assert {k: v for k, v in got.items() if k != 6} == want and got[6] == (0, 0, None)
    assert sum(v[1] for v in want.values()) > 0
    assert line_dedup.remove_repeated_windows(empty).count() == 0
    assert line_dedup.remove_repeated_windows(clashing).columns == clashing.columns
    assert line_dedup.remove_repeated_windows(clashing).count() == 4


def test_later_windows_go_and_ties_stay(spark):
    rows = [(2, "a\nb\nc\nd"), (1, "x\na\nb\nc"), (3, "b\nc\nd"), (1, "x\na\nb\nc"), (4, "p\np\np\np\np")]
    got = sorted((r["doc_id"], r["text"]) for r in line_dedup.line_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(1, "x\na\nb\nc"), (1, "x\na\nb\nc"), (2, "d"), (3, ""), (4, "p")]


def brute_suffix(rows, n=50):
    seen, out = set(), {}
    for i, t in sorted((i, t) for i, t in rows):
        b = (t or "").encode()
        gone, new = bytearray(len(b)), set()
        for k in range(len(b) - n + 1):
            if b[k : k + n] in seen:
                gone[k : k + n] = b"\1" * n
            else:
                new.add(b[k : k + n])
        seen |= new
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup(docs, rows, empty, clashing):
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.report(docs).collect()}
    assert got == brute_suffix(rows)
    assert suffix_dedup.report(empty).count() == 0
    long = clashing.withColumn("text", F.repeat("text", 20))
    assert sorted((r["doc_id"] is None, r["n_removed"] > 0) for r in suffix_dedup.report(long).collect()) == [(False, False), (False, True), (False, True), (True, False)]
    kept = {r["doc_id"]: r["text"] for r in suffix_dedup.deduplicate(docs).collect()}
    assert kept[1] == "" and kept[0] == rows[0][1]


def test_ngram_join(docs, rows, empty, clashing):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs).collect()}
    assert got == brute_components(rows)
    assert ngram_join.components(empty).count() == 0
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in ngram_join.components(clashing).collect()) == [("1", "1")] * 3 + [("None", "None")]
    assert sorted(r["doc_id"] for r in ngram_join.keep_first(docs).collect()) == sorted(i for i, (_, c) in brute_components(rows).items() if i == c)
    assert ngram_join.keep_first(clashing).columns == clashing.columns


def test_ngram_join_of_many_near_copies(spark):
    draw = random.Random(8)
    base = [f"w{draw.randint(0, 999)}" for _ in range(120)]
    rows = []
    for i in range(60):
        own = list(base)
        for _ in range(draw.randint(0, 5)):
            own[draw.randrange(120)] = f"n{draw.randint(0, 9)}"
        rows.append((i, " ".join(own[: draw.randint(100, 120)])))
    rows += [(100 + i, " ".join(f"v{draw.randint(0, 9)}" for _ in range(draw.randint(5, 12)))) for i in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_components(rows)


def test_bounds_never_lose_a_link():
    import numpy as np

    draw = np.random.Generator(np.random.PCG64(1))
    schemes = ngram_join.Schemes()
    for _ in range(300):
        n = int(draw.integers(1, 400))
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        both = a[draw.random(len(a)) < draw.uniform(0.7, 1)]
        b = np.unique(np.concatenate([both, draw.integers(0, 2**63, int(len(a) * draw.uniform(0, 0.2)), dtype=np.uint64)]))
        if len(b) and ngram_join.linked(a, b):
            assert set(schemes.signatures(a).tolist()) & set(schemes.signatures(b).tolist())
            assert ngram_join.overlap_bound(ngram_join.point(a), ngram_join.point(b)) >= ngram_join.least_overlap(len(a) + len(b))


def test_decontamination(spark, docs, rows, empty, clashing):
    items = [(10, " ".join(WORDS)), (9, rows[0][1][:200]), (2, "hello world tis"), (3, None), (4, "..."), (5, rows[13][1][500:900])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = {}
    for item, t in items:
        w = word.findall((t or "").translate(LOWER))
        k = min(10, len(w))
        for i in range(len(w) - k + 1) if k else ():
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    want = {}
    for i, t in rows:
        w = word.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit.update(range(p, p + k))
                    found |= windows[tuple(w[p : p + k])]
        want[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    assert any(v[4] for v in want.values())
    for block in (1 << 20, 300):
        assert {r["doc_id"]: tuple(r)[1:] for r in decontamination.contamination(docs, bench, block_bytes=block).collect()} == want
    assert sorted(r["doc_id"] for r in decontamination.remove_documents(docs, bench).collect()) == sorted(i for i, v in want.items() if not v[4])
    stripped = decontamination.remove_spans(docs, bench)
    assert decontamination.contamination(stripped, bench).filter("doc_id = 16 and contaminated").count() == 0
    assert decontamination.contamination(empty, bench).count() == 0
    assert not any(r["contaminated"] for r in decontamination.contamination(docs, bench.limit(0)).collect())
    assert decontamination.remove_documents(clashing, bench).columns == clashing.columns


def test_short_items_beside_long_ones(spark):
    """Windows of two lengths in one document, the short item before, after and within the long one."""
    long, short = " ".join(f"long{i}" for i in range(12)), "Tiny item here"
    bench = spark.createDataFrame([(1, long), (2, short), (3, "long4 long5")], "item_id bigint, text string")
    texts = [f"a b {short} c {long} d", f"a {long} b c {short} d", f"{short} {long} {short}", f"{short}, x. {short}", f"a {long}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for block in (1 << 20, 100):
        got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.contamination(docs, bench, block_bytes=block).collect()}
        assert got == {0: (15, 3), 1: (15, 3), 2: (18, 3), 3: (6, 1), 4: (12, 2)}
    kept = {r["doc_id"]: r["text"].split() for r in decontamination.remove_spans(docs, bench).collect()}
    assert kept == {0: ["a", "b", "c", "d"], 1: ["a", "b", "c", "d"], 2: [], 3: [",", "x."], 4: ["a"]}


def test_packing(docs, rows, empty, clashing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    pieces = packing.pack(docs, tokenizer_path()).toPandas()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        own = pieces[pieces["doc_id"] == i].sort_values("start")
        assert own["length"].sum() == len(ids) == own["doc_tokens"].iloc[0]
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        for p in own.itertuples():
            raw = b"".join(x.to_bytes(4, "little") for x in ids[p.start : p.start + p.length])
            assert p.ids_crc32 == zlib.crc32(raw)
    for _, s in pieces.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 2048
    whole = packing.packed_pieces(docs, tokenizer_path()).filter("doc_id = 13").orderBy("start").collect()
    assert [x for p in whole for x in p["ids"]] == [*tokenizer.encode(dict(rows)[13], add_special_tokens=False).ids, 1]
    assert packing.pack(empty, tokenizer_path()).count() == 0
    assert packing.pack(clashing, tokenizer_path()).groupBy("doc_id").agg(F.sum("length")).count() == 2


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_harmonic_classes(capacity):
    """Each id in one piece, no hole in a sequence, one short sequence at most, whole documents where longer ones fill."""
    draw = np.random.default_rng(capacity)
    for _ in range(25):
        length = draw.integers(1, int(draw.integers(2, 3 * capacity + 2)), int(draw.integers(1, 80)))
        pieces = packing.placed(length, capacity)
        for key, at, n, total in ((0, 1, 2, length), (3, 4, 2, None)):
            for k in np.unique(pieces[:, key]):
                own = pieces[pieces[:, key] == k]
                own = own[np.argsort(own[:, at])]
                assert own[:, at].tolist() == [0, *np.cumsum(own[:, n]).tolist()[:-1]]
                assert own[:, n].sum() == total[k] if total is not None else own[:, n].sum() <= capacity
        used = np.bincount(pieces[:, 3], weights=pieces[:, 2])
        assert (used < capacity).sum() <= 1
    length = np.concatenate([draw.integers(1, capacity + 1, 300), np.full(40, 9 * capacity)])
    pieces = packing.placed(length, capacity)
    assert np.bincount(pieces[:, 0])[:300].max() == 1
    whole = [b for b in packing.harmonic_bins(length[:300], capacity)]
    assert all(len({capacity // length[i] for i in b}) == 1 and len(b) <= capacity // length[b[0]] for b in whole)


def test_word_ids_with_a_small_cache(monkeypatch):
    from tokenizers import Tokenizer

    """Texts of all kinds of words, with a cache that is emptied again and again."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    tokenizer, words = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    draw = random.Random(8)
    for _ in range(60):
        texts = ["".join("".join(draw.choice("abcdeéÉßABC1.,-'\u0301\u201c中\0\t") for _ in range(draw.choice([1, 2, 3, 6, 70]))) + draw.choice([" ", " ", ". ", ", ", "\n", "  "]) for _ in range(draw.randint(0, 30))) for _ in range(3)]
        raw = [t.encode() for t in texts]
        ids, at = words.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [ids[lo:hi].tolist() for lo, hi in zip(at[:-1], at[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_gif_round_trip(docs, rows, empty, clashing):
    got = {r["doc_id"]: r for r in gif.media_digests(docs).collect()}
    for i, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
    assert got[5]["feature"] == got[6]["feature"] and got[0]["media_sha256"] == got[1]["media_sha256"]
    assert gif.media_digests(empty).count() == 0 and gif.media_digests(clashing).count() == 4


def lzw(samples, code_size):
    """A greedy encoder, for streams with codes beyond literals."""
    clear = 1 << code_size
    table = {bytes([i]): i for i in range(clear)}
    width, codes, held = code_size + 1, [(clear, code_size + 1)], b""
    for s in samples:
        if held + bytes([s]) in table:
            held += bytes([s])
            continue
        codes.append((table[held], width))
        if len(table) + 2 < 4096:
            table[held + bytes([s])] = len(table) + 2
            if len(table) + 2 > 1 << width and width < 12:
                width += 1
        held = bytes([s])
    codes += [(table[held], width), (clear + 1, width)]
    value = shift = 0
    for code, n in codes:
        value |= code << shift
        shift += n
    data = value.to_bytes(-(-shift // 8), "little")
    return bytes([code_size]) + b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def frame(samples, box, code_size=2, disposal=0, transparent=None, delay=5, interlaced=False, palette=None):
    left, top, w, h = box
    control = bytes([0x21, 0xF9, 4, disposal << 2 | (transparent is not None), delay, 0, transparent or 0, 0])
    flags = (0x40 if interlaced else 0) | (0x81 if palette else 0)
    return control + bytes([0x2C, left, 0, top, 0, w, 0, h, 0, flags]) + (palette or b"") + lzw(samples, code_size)


def test_gif_rules(spark):
    palette = bytes([0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
    head = b"GIF89a" + bytes([4, 0, 4, 0, 0x81, 0, 0]) + palette
    draw = random.Random(2)
    noise = [draw.randrange(4) for _ in range(16)]
    frames = [frame([1] * 16, (0, 0, 4, 4)), frame([2, 0, 0, 2], (1, 1, 2, 2), disposal=2, transparent=0), frame([3] * 4, (0, 0, 2, 2), disposal=3), frame(noise, (0, 0, 4, 4), interlaced=True), frame([1] * 4, (0, 0, 2, 2), palette=bytes([9] * 12))]
    width, height, parsed = gif.parse(head + b"".join(frames) + b";")
    screens = [s.copy() for s in gif.canvases(width, height, parsed)]
    red, green, blue = [255, 0, 0], [0, 255, 0], [0, 0, 255]
    assert screens[0][3][3].tolist() == red
    assert screens[1][1][1].tolist() == green and screens[1][1][2].tolist() == red
    assert screens[2][1][1].tolist() == blue and screens[2][2][2].tolist() == [0, 0, 0] and screens[2][3][3].tolist() == red
    order = [0, 2, 1, 3]
    table = [[0, 0, 0], red, green, blue]
    assert [screens[3][r][c].tolist() for k, r in enumerate(order) for c in range(4)] == [table[x] for x in noise]
    assert screens[4][0][0].tolist() == [9, 9, 9]
    media = spark.createDataFrame([(1, bytearray(head + b"".join(frames) + b";"), "x"), (2, bytearray(b"GIF8"), "y"), (3, None, "z")], "k int, media binary, frames string")
    got = {r["k"]: r for r in gif.decode_media(media).collect()}
    assert [(f["start_ms"], f["length_ms"]) for f in got[1]["frames"]] == [(50 * i, 50) for i in range(5)]
    assert sum(got[1]["frames"][0]["histogram"]) == 48 and got[2]["error"] and got[3]["frames"] is None
    for size in (2, 5, 8):
        raw = bytes(draw.randrange(1 << size) // 3 for _ in range(9000))
        coded = lzw(raw, size)
        data, _ = gif._sub_blocks(coded, 1)
        assert gif.lzw_decode(data, size, len(raw)) == raw
        assert gif.lzw_decode(gif.packed_codes(gif.lzw_codes(raw, size), size), size, len(raw)) == raw
    wide = bytes(draw.randrange(256) for _ in range(20000))
    assert gif.lzw_decode(gif.packed_codes(gif.lzw_codes(wide)), 8, len(wide)) == wide
    bad = [(1, b"GIF89a" + b"\xff\xff\xff\xff\x80\0\0" + bytes(6) + frames[0] + b";"), (2, (head + frames[0]).replace(b"\x02", b"\x0c") + b";")]
    assert all(r["error"] for r in gif.decode_media(spark.createDataFrame([(k, bytearray(m)) for k, m in bad], "k int, media binary")).collect())


def test_gif_writer_uses_codes_and_transparency():
    text = ("the cat sat on the mat and " * 90).encode()[:2304]
    media = gif.write([text])[0]
    _, _, frames = gif.parse(media)
    assert len(frames) == 4 and [f.transparent for f in frames] == [-1, 0xF5, 0xF5, 0xF5] and len(media) < len(gif.HEADER) + 2000
    assert next(gif.read([media]))[0] == text


def test_license_scan(spark, docs, empty, clashing):
    rows = [(1, "x\nLicensed under the Apache License, Version 2.0.\ny"), (2, "  released UNDER the   MIT license "), (3, None), (4, ""), (5, "plain words of a text that is no notice at all"), (6, "MIT")]
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1] == (3, 1, "apache-2.0", 1.0) and got[2][2] == "mit"
    assert got[3] == (0, 0, "", 0.0) and got[4] == (1, 0, "", 0.0) and got[5][1] == 0 and got[6][1] == 0
    assert license_scan.scan(empty).count() == 0 and license_scan.scan(clashing).count() == 2


def test_licenses_over_lines(spark):
    """Wrapped headers, a notice within a paragraph and whole licence files, by a brute-force score of known runs."""
    import textwrap

    wrap = lambda name, mark: "\n".join(mark + x for x in textwrap.wrap(license_scan.NOTICES[name], 60))
    full = license_scan.full_texts()
    rows = [(i, f"import os\n{wrap(name, mark)}\ndef f(): return 1") for i, (name, mark) in enumerate([("apache-2.0-header", "# "), ("mit-permission", " * "), ("bsd", "// "), ("gpl-3.0-header", "    ")])]
    rows += [(10, "Some words before. This work is licensed under the GNU General Public License, version 3. And " + "many more words after it " * 30)]
    rows += [(20 + i, f"Copyright 2020 Somebody\n\n{full[name]}") for i, name in enumerate(sorted(full))]
    rows += [(40, wrap("bsd", "") + "\n" + "other words here\n" * 40 + wrap("bsd", "")), (41, "in the form of the License. You may use the work for any purpose with or without it\n" * 9)]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, name in enumerate(["apache-2.0-header", "mit-permission", "bsd", "gpl-3.0-header"]):
        assert name in got[i]["licenses"].split(",") and got[i]["best_score"] == 1.0
    assert got[10]["licenses"] == "gpl-3.0" and got[10]["n_notices"] == 1 and got[10]["best_score"] == 1.0
    for i, name in enumerate(sorted(full)):
        assert name in got[20 + i]["licenses"].split(",") and got[20 + i]["best_score"] == 1.0
    assert got[40]["licenses"] == "bsd" and got[40]["n_notices"] == 1
    assert got[41]["n_notices"] == 0 and got[41]["n_lines"] == 10


def test_warc(spark):
    html = '<html><head><title> A &amp; B </title></head><body><script>no</script><p>One <b>two</b></p><p>x &lt; y</p><a href="/l">k</a></body></html>'
    pages = spark.createDataFrame([(1, "http://a/", html, 5), (2, None, None, 6)], "page_id bigint, url string, html string, block int")
    out = warc.records(warc.derivatives(warc.responses_from_pages(pages))).collect()
    one = {r["warc_type"]: r for r in out if r["page_id"] == 1}
    assert one["conversion"]["block"] == "One two\nx < y\nk" and "title: A & B\r\n" in one["metadata"]["block"] and "outlink: /l\r\n" in one["metadata"]["block"]
    for r in out:
        assert r["block_digest"] == "sha256:" + hashlib.sha256(r["block"].encode()).hexdigest() and r["content_length"] == len(r["block"].encode())
        assert f"WARC-Refers-To: {r['refers_to']}\r\n" in r["record"] and r["record"].endswith("\r\n\r\n")
    assert one["metadata"]["refers_to"] == one["conversion"]["refers_to"] != one["metadata"]["record_id"]
    assert one["metadata"]["source_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    assert len(out) == 4 and warc.derivatives(warc.responses_from_pages(pages.limit(0))).count() == 0


def test_warc_references_and_links(spark):
    """Every named and numeric reference and all quotings of href, against Python's HTML parser."""
    import html.entities
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            self.found += [v for k, v in attrs[::-1] if tag == "a" and k == "href"][-1:]

    names = [n for n in sorted(html.entities.html5) if n.endswith(";") and html.entities.html5[n].strip() and "\xa0" not in html.entities.html5[n]]
    body = "<p>" + "</p><p>".join(f"x&{n}y" for n in names) + "</p><p>it&#8217;s &#x27;so&#X27; &copy; &middot; a&nbsp;b &amp;lt; &nosuch;</p>"
    anchors = """<a href="/d?a=1&amp;b=2">1</a><a href='/s'>2</a><a href=/bare>3</a><A class='x' HREF = '/up'>4</A><a title="href=/no" href=/yes>5</a><a data-href="/no">6</a><a name=n>7</a><a id="a>b" href="/gt">8</a><abbr href="/no">9</abbr>"""
    parser = Links()
    parser.feed(anchors)
    pages = spark.createDataFrame([(1, "http://a/", body), (2, "http://b/", anchors)], "page_id bigint, url string, html string")
    out = {(r["page_id"], r["warc_type"]): r["block"] for r in warc.derivatives(warc.responses_from_pages(pages)).collect()}
    assert out[1, "conversion"].split("\n")[-1] == "it\u2019s 'so' \xa9 \xb7 a b &lt; &nosuch;"
    assert out[1, "conversion"].split("\n")[: len(names)] == [f"x{html.entities.html5[n]}y" for n in names]
    assert re.findall("outlink: (.*)\r\n", out[2, "metadata"]) == parser.found == ["/d?a=1&b=2", "/s", "/bare", "/up", "/yes", "/gt"]
