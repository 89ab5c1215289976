import hashlib
import zlib

from tilewright.llm import media


def test_round_trip(spark):
    rows = [(1, "a"), (2, ""), (3, None), (4, "é" * 96), (5, "x" * 193), (6, "a"), (6, "a"), (7, "line\n\x00\n255\n"), (8, "\n<p>a &amp; <img src=\"sha256:zz\">\n</p>"), (9, "word " * 400_000)]
    docs = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, digest string, n_bytes int")
    got = media.text_media(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        b = (dict(rows)[r["doc_id"]] or "").encode()
        p = b + b" " * (max(192, -(-len(b) // 192) * 192) - len(b))
        stored = media.encode_image(p)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), hashlib.sha256(stored).hexdigest()) and media.decode_image(stored)[2] == p
        assert r["position"] == int(bool((dict(rows)[r["doc_id"]] or "").split("\n")[0].split())) and r["caption"] == f"text of {len(b)} bytes" and r["feature"] == media.feature(64, len(p) // 192, p)
    assert media.text_media(docs.limit(0)).count() == 0


def test_sequences(spark):
    html = '<html><head><title>no</title></head><body><h1>A &amp; B</h1><script>var t="</p>";</script><p>one<br>two <img src="sha256:aa" alt="alt"></p><figure><img src="b.png"><figcaption>cap <b>bold</b></figcaption></figure><img src="sha256:zz"> end<!-- x -->'
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<p>open <b"), (5, "<![bad")], "page_id long, html string")
    seq = media.interleave(pages)
    by = {r["id"]: [tuple(x) for x in r["items"]] for r in seq.collect()}
    assert by[1] == [(0, "text", "A & B one two", None), (1, "media", "alt", "sha256:aa"), (2, "media", "", "b.png"), (3, "caption", "cap bold", None), (4, "media", "", "sha256:zz"), (5, "text", "end", None)]
    assert by[2] == by[3] == [] and len(by) == 5
    store = spark.createDataFrame([("aa", 5)], "digest string, size int")
    assert sorted((r["position"], r["caption"], r["size"]) for r in media.resolve(seq, store).where("id = 1").collect()) == [(1, "alt", 5), (4, "", None)]


def test_repeated_digests_and_empty_stores(spark):
    page = '<p>a<img src="sha256:aa"></p>'
    seq = media.interleave(spark.createDataFrame([(i, page) for i in range(50)], "page_id long, html string"))
    twice = spark.createDataFrame([("aa", 5), ("aa", 5), ("bb", 6)], "digest string, size int")
    assert [r["size"] for r in media.resolve(seq, twice).collect()] == [5] * 50
    assert [r["size"] for r in media.resolve(seq, twice.limit(0)).collect()] == [None] * 50
    one = media.encode_image(media.padded(b"x"))
    store = spark.createDataFrame([("d", one, 1)] * 3 + [("e", None, 1), (None, one, 2)], "digest string, media binary, feature int")
    assert media.inspect(store).count() == 1 and media.inspect(store.limit(0)).count() == 0
