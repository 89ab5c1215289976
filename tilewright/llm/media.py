"""Media columns: interleaved sequences of text and media references, and a media store resolved by digest.

``interleave`` parses pages into ordered sequences: text and media references as structs at their positions, captions with
their media. ``store_media`` writes payloads as images into a store table; ``inspect`` reads the stored bytes back and
computes features; ``resolve`` joins references and stored media on the digest of the stored form. Payloads are stored and
read where they are; only digests and features are shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tilewright.llm import bytetext as bt
from tilewright.sources.scratch import written

#: A row of an image: 64 pixels of 3 samples.
WIDTH, CHANNELS = 64, 3
ROW = WIDTH * CHANNELS

SEQUENCE = "array<struct<position: int, kind: string, text: string, ref: string>>"


class _Reader(HTMLParser):
    """Collects visible text and media references in the order of the page; a caption follows its medium."""

    HIDDEN = {"script", "style", "head", "template", "noscript"}
    MEDIA = {"img", "audio", "video", "source"}
    VOID = {"img", "source", "br", "hr", "meta", "link", "input"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[str, str, str | None]] = []
        self.hidden = 0
        self.caption = 0

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag == "figcaption":
            self.caption += 1
        elif tag in self.MEDIA and not self.hidden:
            found = dict(attrs)
            if found.get("src"):
                self.items.append(("media", found.get("alt") or "", found["src"]))

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption":
            self.caption = max(0, self.caption - 1)

    def handle_data(self, data):
        text = " ".join(data.split())
        if text and not self.hidden:
            kind = "caption" if self.caption else "text"
            if self.items and self.items[-1][0] == kind:
                self.items[-1] = (kind, f"{self.items[-1][1]} {text}", None)
            else:
                self.items.append((kind, text, None))


def _sequence(html: str | None) -> list[dict]:
    reader = _Reader()
    try:
        reader.feed(html or "")
        reader.close()
    except AssertionError:  # a malformed declaration ends the page there
        pass
    return [{"position": i, "kind": k, "text": t, "ref": r} for i, (k, t, r) in enumerate(reader.items)]


def interleave(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, items): each page's ordered sequence of ``text``, ``media`` (``ref``, with its alternative text) and ``caption``.

    A null or empty page has an empty sequence; malformed markup is read as far as a browser-like parser gets. Repeated
    rows stay. Other columns are not looked at.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string())]))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_sequence(x) for x in batch.column(1).to_pylist()], kind)], ["id", "items"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(parse, f"id {rows.schema['id'].dataType.simpleString()}, items {SEQUENCE}")


def encode_image(payload: bytes) -> bytes:
    """A binary PPM image of 8-bit samples whose samples are the payload; its length is a positive multiple of a row."""
    return b"P6\n%d %d\n255\n" % (WIDTH, len(payload) // ROW) + payload


def decode_image(media: bytes) -> tuple[int, int, bytes]:
    """(width, height, samples) of a binary PPM image of 8-bit samples."""
    magic, size, most, samples = media.split(b"\n", 3)
    width, height = map(int, size.split())
    if magic != b"P6" or most != b"255" or len(samples) != width * height * CHANNELS:
        raise ValueError("not a binary PPM image of 8-bit samples")
    return width, height, samples


def padded(text: bytes) -> bytes:
    n = len(text)
    return text + b" " * (max(ROW, -(-n // ROW) * ROW) - n)


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The written store: (id, n_bytes, digest, media), the text's bytes padded with spaces to whole image rows as an image."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bt.column_bytes(batch.column(1))
            for i, j, d, o in bt.slices(data, off, 4 << 20):
                media = [encode_image(padded(d[a:b].tobytes())) for a, b in zip(o[:-1], o[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(o)), pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string()), pa.array(media, pa.binary())],
                    ["id", "n_bytes", "digest", "media"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, digest string, media binary"), "media")


def feature(width: int, height: int, samples: bytes) -> str:
    """Size, mean and deviation of each channel, and the shares of eight levels of brightness."""
    x = np.frombuffer(samples, np.uint8).reshape(-1, CHANNELS)
    count = [np.bincount(x[:, c], minlength=256) for c in range(CHANNELS)]
    level = np.arange(256)
    mean = [float(c @ level) / len(x) for c in count]
    sd = [max(0.0, float(c @ level**2) / len(x) - m * m) ** 0.5 for c, m in zip(count, mean, strict=True)]
    share = sum(count).reshape(8, 32).sum(axis=1) / x.size
    show = lambda v: ",".join(f"{y:.4f}" for y in v)
    return f"{width}x{height} mean={show(mean)} sd={show(sd)} levels={show(share)}"


_SEEN = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def inspect(store: DataFrame, digest_col: str = "digest", media_col: str = "media") -> DataFrame:
    """One row for each digest of the store: what its bytes, read back and decoded, hold.

    Rows with null media or a null digest are left out; a digest that stands on several rows, whose media are the same bytes, gives
    one row; an empty store gives an empty result. Other columns are not looked at.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()  # a task decodes each digest once
        for batch in batches:
            rows = []
            for digest, media in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if digest in seen:
                    continue
                seen.add(digest)
                stored = media.as_buffer().to_pybytes()
                width, height, samples = decode_image(stored)
                rows.append((digest, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(width, height, samples)))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            cols = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], [x.split()[0] for x in _SEEN.split(", ")])

    rows = store.where(F.col(media_col).isNotNull() & F.col(digest_col).isNotNull()).select(F.col(digest_col).alias("digest"), F.col(media_col).alias("media"))
    return rows.mapInArrow(read, _SEEN).dropDuplicates(["digest"])


def resolve(sequences: DataFrame, media: DataFrame, scheme: str = "sha256:") -> DataFrame:
    """(id, position, caption, digest, and the media columns) for each reference ``scheme`` + digest of the sequences.

    A reference that the store lacks has null media columns; a digest that ``media`` has twice counts once. The caption is that
    which follows the medium at once, else its alternative text. References to a digest that very many pages share are split over
    tasks by adaptive execution: the join shuffles by a further key, apart from the aggregate before it.
    """
    after = F.try_element_at("items", F.col("item.position") + 2)
    caption = F.when(after["kind"] == "caption", after["text"]).otherwise(F.col("item.text"))
    refs = sequences.select("id", "items", F.explode("items").alias("item")).where(F.col("item.kind") == "media").where(F.col("item.ref").startswith(scheme))
    refs = refs.select("id", F.col("item.position").alias("position"), caption.alias("caption"), F.expr(f"substring(item.ref, {len(scheme) + 1})").alias("digest"))
    media = media.dropDuplicates(["digest"]).withColumn("_k", F.xxhash64("digest"))
    return refs.withColumn("_k", F.xxhash64("digest")).join(media, ["digest", "_k"], "left").drop("_k")


def figure(digest: Column, caption: Column) -> Column:
    return F.concat(F.lit('<figure><img src="sha256:'), digest, F.lit('" alt=""><figcaption>'), caption, F.lit("</figcaption></figure>"))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def page_of(text: Column, digest: Column, n_bytes: Column) -> Column:
    """A page of a text: its first line, a figure that shows the text's stored form, and its other lines."""
    head = F.substring_index(text, "\n", 1)
    tail = F.substr(text, F.length(head) + 2)
    return F.concat(F.lit("<article><h1>"), _escaped(head), F.lit("</h1>"), figure(digest, F.concat(F.lit("text of "), n_bytes.cast("string"), F.lit(" bytes"))), F.lit("<p>"), _escaped(tail), F.lit("</p></article>"))


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, position, caption).

    Each text is stored as an image. Its page, made from the stored bytes, has the text's lines around a figure that refers to
    the image by digest; the page is parsed into its sequence, the reference resolved in the store, and the stored bytes are
    read back. ``position`` is the medium's place in the sequence: 1 after a first line that has words, else 0. A null text counts
    as empty; rows that share an id stay; texts may be of any length; an empty table gives an empty result. Other columns are
    not looked at.
    """
    store = store_media(docs, id_col, text_col)
    text = F.decode(F.expr(f"substring(media, length(media) - greatest({ROW}, cast(ceil(n_bytes / {ROW}) as int) * {ROW}) + 1, n_bytes)"), "UTF-8")
    pages = store.select(F.struct("id", "n_bytes").alias("key"), page_of(text, F.col("digest"), F.col("n_bytes")).alias("html"))
    found = resolve(interleave(pages, "key", "html"), inspect(store))
    return found.select(F.col("id.id").alias("doc_id"), F.col("id.n_bytes").alias("n_bytes"), "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
