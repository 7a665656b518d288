"""Archives, alignment of tokenizers, and periodic runs: brute force, libraries, damaged and hard input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import zstandard
from llm_fixtures import HARD, PROSE
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registered
from podium.config import SizingConfig
from podium.llm import alignment, periodic_runs, warc
from podium.llm.queries import alignment_models
from podium.session import work_folder

SMALL = "/root/testdata/sf0.001"


def by_id(frame, id_col="doc_id"):
    return {row[id_col]: row for row in frame.collect()}


# ---- archives


HTML = "<html><body>" + "the same old page " * 20 + "</body></html>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://a.example/{k}", HTML if k % 3 else f"<p>{k} {'x' * (k * 7)}</p>", 1) for k in range(1, 60)]
    rows += [
        (60, None, None, 1), (61, "http://b/", "", 1), (62, "http://b/\r\nX: 1", "short", 1), (63, "http://é/ü", "short", 1),
        (None, "http://c/", HTML, 1), (None, "http://c/", "y" * 200, 1), (None, "http://d/", "y" * 200, 1),
        (64, "http://e/", "z" * 99, 1), (65, "http://e/", "z" * 99, 1), (66, "http://e/", "é" * 50, 1), (67, "u", "é" * 50, 1),
        (1, "http://a.example/1", HTML, 1), (68, "http://big/", "日本" * 700_000, 1),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload int").repartition(4)


@pytest.fixture(scope="module")
def archives(spark, pages):
    folder = work_folder(spark, "archives")
    warc.write_archives(pages, folder)
    return folder


def test_pages_come_back(spark, pages, archives):
    records = warc.resolved(warc.read_archives(spark, archives, strict=True)).collect()
    wanted = Counter((r.page_id, (r.html or "").encode()) for r in pages.collect())
    first = {}
    for page_id, payload in wanted:
        if page_id is not None and len(payload) >= 100:
            first[payload] = min(page_id, first.get(payload, page_id))
    found = Counter()
    payload_of = {hashlib.sha256(payload).hexdigest(): payload for _, payload in wanted}
    for r in records:
        page_id = int(r.headers[warc.PAGE_ID]) if warc.PAGE_ID in r.headers else None
        payload = payload_of[r.payload_digest]
        found[page_id, payload] += 1
        assert r.payload_bytes == len(payload)
        if first.get(payload, page_id) == page_id:
            assert r.record_type == "response" and bytes(r.payload) == payload and r.refers_to is None
        else:
            assert r.record_type == "revisit" and r.payload is None
            assert int(r.refers_to[warc.PAGE_ID]) == first[payload]
    assert found == wanted


def test_url_headers(spark, archives):
    urls = {r.headers.get(warc.PAGE_ID): r.headers["WARC-Target-URI"] for r in warc.read_archives(spark, archives).collect()}
    assert (urls["60"], urls["62"], urls["63"]) == ("urn:x-page:60", "http://b/%0D%0AX:%201", "http://é/ü")


def test_other_tools_read_the_archives(spark, archives):
    """Plain Zstandard with the dictionary of the first frame decodes all frames after it."""
    for row in spark.read.format("binaryFile").load(archives).collect():
        data = bytes(row.content)
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        learned = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        reader = zstandard.ZstdDecompressor(dict_data=learned).stream_reader(data[8 + size :], read_across_frames=True)
        assert reader.read().count(b"WARC/1.1\r\n") == sum(1 for _ in warc.records_of(data))


def test_large_tables_become_several_archives(spark, pages):
    folder = work_folder(spark, "archives")
    warc.write_archives(pages.coalesce(1), folder, archive_bytes=1 << 19)
    records = warc.read_archives(spark, folder, strict=True)
    assert records.count() == pages.count() and records.select("archive").distinct().count() > 1


def test_no_pages(spark, pages):
    folder = work_folder(spark, "archives")
    warc.write_archives(pages.limit(0), folder)
    assert warc.resolved(warc.read_archives(spark, folder)).collect() == []


def whole(*raw: bytes, dictionary: bytes = b"", packed: bool = False) -> bytes:
    learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    kept = zstandard.compress(dictionary) if packed else dictionary
    head = warc.DICTIONARY_MAGIC.to_bytes(4, "little") + len(kept).to_bytes(4, "little") + kept if dictionary else b""
    return head + b"".join(zstandard.ZstdCompressor(dict_data=learned).compress(r) for r in raw)


@pytest.fixture(scope="module")
def learned():
    pick = random.Random(1)
    samples = [" ".join(pick.choices(PROSE.split(), k=80)).encode() for _ in range(400)]
    return zstandard.train_dictionary(4096, samples).as_bytes()


def good(k: int = 1, payload: bytes = b"hello") -> bytes:
    return warc.record(k, f"http://a/{k}", payload, hashlib.sha256(payload).hexdigest(), None, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize("packed", [False, True])
def test_dictionaries(learned, packed):
    found = list(warc.records_of(whole(good(1, PROSE.encode()), good(2), dictionary=learned, packed=packed)))
    assert [r["payload"] for r in found] == [PROSE.encode(), b"hello"]


def test_frames_without_size_and_in_many_blocks():
    payload = random.Random(1).randbytes(600_000) + b"a" * 400_000
    maker = zstandard.ZstdCompressor(write_content_size=False, write_checksum=True).compressobj()
    raw = good(1, payload)
    data = maker.compress(raw[:300_000]) + maker.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK) + maker.compress(raw[300_000:]) + maker.flush()
    skip = warc.SEPARATOR.encode() + (warc.SKIPPABLE_MAGIC + 3).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"notes"
    found = list(warc.records_of(data + skip + whole(good(2))))
    assert [r.get("problem") for r in found] == [None, None] and found[0]["payload"] == payload


@pytest.mark.parametrize(
    "spoil, told",
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1), "version"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Dote", 1), "without WARC-Date"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type response", 1), "header line"),
        (lambda r: r.replace(b"WARC-Date", b"WARC-Type", 1), "twice"),
        (lambda r: r[:-4] + b"\r\n\n\n", "two line ends"),
        (lambda r: r + b"more", "Content-Length"),
        (lambda r: r[:-5] + b"\r\n\r\n", "Content-Length"),
        (lambda r: r.replace(b"hello", b"hullo"), "digest"),
        (lambda r: re.sub(rb"(?<=\r\n)Content-Length: \d+", b"Content-Length: -1", r, count=1), "Content-Length '-1'"),
        (lambda r: r.replace(b"Content-Length: 5", b"Content-Length: 6"), "HTTP Content-Length"),
        (lambda r: r.replace(b"\r\n\r\n", b"\r\n"), "no end"),
        (lambda r: b"", "no end"),
        (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: revisit", 1), "revisit without"),
    ],
)
def test_faulty_records(spoil, told):
    found = list(warc.records_of(whole(good(1), spoil(good(2)), good(3))))
    assert [told in r["problem"] if "problem" in r else None for r in found] == [None, True, None]


@pytest.mark.parametrize("cut", [2, 7, 60, -1, -3])
def test_cut_archives(cut):
    data = whole(good(1), good(2))
    found = list(warc.records_of(data[: len(whole(good(1)))] + data[len(whole(good(1))) :][:cut]))
    assert "problem" not in found[0] and found[1]["problem"].startswith("archive:")


def test_strict_reading_fails(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(whole(good(1)) + b"junk")
    assert warc.read_archives(spark, str(tmp_path)).where("problem is not null").count() == 1
    with pytest.raises(Exception, match="no frame"):
        warc.read_archives(spark, str(tmp_path), strict=True).collect()


# ---- alignment


BYTE_OF = alignment._byte_table()


def pieces_of(text, a_model, b_model):
    """Bytes of both tokenizers' tokens, from the libraries' own tables."""
    a = a_model.encode(" " + text, add_special_tokens=False).ids
    b = b_model.encode(text)
    a_bytes = [bytes(BYTE_OF[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()
        for p in map(b_model.id_to_piece, b)
    ]
    return a, b, a_bytes, b_bytes


def brute_alignment(texts):
    a_path, b_path = alignment_models()
    a_model, b_model = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_model.encode_special_tokens = True
    groups, counts = [], Counter()
    for text in texts:
        found = []
        if text:
            a, b, a_bytes, b_bytes = pieces_of(text, a_model, b_model)
            if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
                a_ends, b_ends = np.cumsum([*map(len, a_bytes)]).tolist(), np.cumsum([*map(len, b_bytes)]).tolist()
                i = j = 0
                for cut in sorted({*a_ends} & {*b_ends}):
                    to_i, to_j = a_ends.index(cut, i) + 1, b_ends.index(cut, j) + 1
                    found.append((a[i:to_i], b[j:to_j]))
                    i, j = to_i, to_j
        groups.append(found)
        counts.update({(x, y) for left, right in found for x in left for y in right})
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for found in groups:
        linked = [(x, y) for left, right in found for x in left for y in right]
        rows.append((
            sum(len(x) for x, _ in found), sum(len(y) for _, y in found), len(found), len(linked),
            sum(counts[p] == most[p[0]] for p in linked), sum(counts[p] for p in linked),
            ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in found),
        ))
    return rows


ODD = [
    "a", " ", "  ", " a", "a ", "\n", "▁", "a▁b", "<s>", "</s> <unk> <0x41>", "<|endoftext|>", "don't  stop\tnow ",
    "日本語 テキスト", "x  y 　z   w", "́ ́a", "😀 😀😀", "a\x00b \x1f c\x85 d", "1 2 33 444", "ﬁ Å ½", "word",
    "word", "the the the " * 300,
]


@pytest.mark.parametrize("limit", [SizingConfig(), SizingConfig(broadcast_bytes=-1, hot_share=0.01)])
def test_alignment(spark, limit):
    rows = [*enumerate(ODD), *((100 + r[0], r[1]) for r in HARD if len(r[1] or "") < 10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = by_id(alignment.aligned(docs, *alignment_models(), sizing=limit))
    assert {k: tuple(r)[1:] for k, r in found.items()} == dict(
        zip([k for k, _ in rows], brute_alignment([t for _, t in rows]), strict=True)
    )


def test_alignment_of_mixed_signs():
    """Texts put together from signs that tokenizers split on, chunk by chunk and whole."""
    pick = random.Random(5)
    signs = [*ODD[:12], "b ", " ", "é", "日", "'s", ".", " x", "\r\n", "\x85", "​", " ,", "don't"]
    texts = ["".join(pick.choices(signs, k=pick.randrange(14))) for _ in range(800)]
    a_path, b_path = alignment_models()
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        chunks = alignment.Chunks(alignment.Models(a.read(), b.read()))
    found = [(*row[:4], row[4]) for row in alignment._align(pa.array(texts), chunks)]
    assert found == [(*row[:4], row[6]) for row in brute_alignment(texts)]


def test_pointers():
    pick = random.Random(2)
    for _ in range(300):
        n = pick.randrange(1, 60)
        a = sorted({*(pick.sample(range(1, n + 1), pick.randrange(1, n + 1))), n})
        b = sorted({*(pick.sample(range(1, n + 1), pick.randrange(1, n + 1))), n})
        cuts = sorted({*a} & {*b})
        in_a, in_b = alignment.pointers(np.array(a), np.array(b))
        assert in_a.tolist() == np.searchsorted(cuts, a).tolist() and in_b.tolist() == np.searchsorted(cuts, b).tolist()


def test_alignment_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = by_id(registered.queries()["op12_token_alignment"](spark, SMALL))
    for row, wanted in zip(rows, brute_alignment([r.text for r in rows]), strict=True):
        digest = hashlib.sha256(wanted[6].encode()).hexdigest() if wanted[6] else ""
        assert tuple(found[row.doc_id]) == (row.doc_id, *wanted[:6], digest)


# ---- periodic runs


def brute_runs(words, min_length=6, min_exponent=4):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        for same, places in groupby(range(n - q), lambda i: words[i] == words[i + q]):
            places = list(places)
            start, length = places[0], len(places) + q
            if not same or length < max(min_length, min_exponent * q, 2 * q):
                continue
            own = words[start : start + length]
            if not any(own[d:] == own[:-d] for d in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("least", [(6, 4), (2, 2), (6, 2.5), (3, 3), (9, 5)])
def test_runs(least):
    pick = random.Random(3)
    for _ in range(250):
        words, k = [], pick.choice([1, 2, 3, 6])
        while len(words) < pick.randrange(70):
            words += [str(pick.randrange(k)) for _ in range(pick.randrange(1, 6))] * pick.choice([1, 1, 2, 4, 5, 7])
        raw = np.frombuffer(" ".join(words).encode(), np.uint8)
        (n,), (runs,), (text,) = periodic_runs._judged(raw, np.array([0, len(raw)]), *least)
        wanted = brute_runs(words, *least)
        assert ([] if runs is None else [tuple(r) for r in runs.tolist()]) == wanted
        assert n == len(words) and text.decode() == collapsed(words, wanted)
        numbers = np.unique(words, return_inverse=True)[1].astype(np.uint64) if words else np.zeros(0, np.uint64)
        assert [tuple(r) for r in periodic_runs.runs_in(numbers, *least).tolist()] == wanted


def test_extensions():
    pick = random.Random(4)
    for _ in range(100):
        words = np.array([pick.randrange(1, 4) for _ in range(pick.randrange(2, 50))])
        own = periodic_runs.Extensions(words, 4)
        a, b = (g.ravel() for g in np.indices((len(words), len(words))))
        a, b = a[a != b], b[a != b]

        def common(i, j):
            k = 0
            while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            return k

        assert own.common(a, b).tolist() == [common(i, j) for i, j in zip(a.tolist(), b.tolist())]
        assert own.leaves.tolist() == sorted(range(len(words) + 1), key=lambda i: words[i:].tolist())


def test_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 800:
        a, b = b, b + a
    numbers = np.frombuffer(b.encode(), np.uint8).astype(np.uint64)
    assert [tuple(r) for r in periodic_runs.runs_in(numbers, 2, 2).tolist()] == brute_runs(b, 2, 2)


def test_runs_of_hard_texts(hard):
    found = by_id(periodic_runs.periodic_runs(hard))
    assert found[4].n_words == found[5].n_words == found[6].n_words == 0 and found[5].collapsed == found[4].collapsed == ""
    assert [tuple(r) for r in found[8].runs] == [(0, 40_000, 1)] and found[8].collapsed == "word"
    assert found[9].n_words == 1 and found[11].collapsed == "a\x00b\x1c c d"
    assert found[1].runs == [] and found[1].collapsed == PROSE


def test_runs_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = [*((r.doc_id, r.text) for r in rows)]
    found = by_id(registered.queries()["op13_periodic_runs"](spark, SMALL))
    made = 0
    for doc_id, text in rows:
        words = split(text)
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        # Brute force is too slow for long texts; they are compared in the tests of the method alone.
        wanted = brute_runs(words) if n <= 500 else None
        row = found[doc_id]
        if wanted is not None:
            lines = "".join(f"{s},{size},{q}\n" for s, size, q in wanted)
            top = min(wanted, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            made += bool(wanted)
            assert tuple(row) == (
                doc_id, len(wanted), *top, 1000 * top[1] // top[2] if wanted else None,
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, wanted).encode()).hexdigest(),
            )
    assert made > 2


def test_every_row_of_hard_tables(hard, empty):
    for operator in (
        lambda docs: alignment.aligned(docs, *alignment_models()),
        periodic_runs.periodic_runs,
    ):
        ids = sorted(r.doc_id for r in operator(hard).select("doc_id").collect())
        assert ids == sorted([*(row[0] for row in HARD), 1])
        assert operator(empty).collect() == []
        no_id = operator(hard.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))).collect()
        assert [r.doc_id for r in no_id] == [None, None]
