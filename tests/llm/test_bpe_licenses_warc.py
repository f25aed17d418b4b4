"""Encoding against the tokenizers library, licenses against brute force, archives by round trip."""

import collections
import gzip
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vulnlake.llm import bpe, common, license_scan, queries, warc
from awkward import SF_DIR, documents, no_documents  # noqa: F401

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


ODD = [
    "", None, "ΑΣ ΟΔΟΣ Σ", "İstanbul DŽ ǅ", "x\x1cy\x1f z\x85q\xa0w　e", "a" * 5000, "hi<|endoftext|>World <|startoftext|>", "<|ENDOFTEXT|>",
    "don't I'LL we've 'S", "é é ﬁ ①", "日本語テキスト" * 50, "🎉👩‍👩‍👧 ok", "\0 nul", "'" * 100 + "s", "__a_b__ 1234567 3.14", "\U00010940 Ᲊx",
]


def test_ids_equal_the_library(library):
    rng = random.Random(2)
    letters = [chr(c) for a, b in ((32, 591), (880, 1500), (7680, 8400), (12288, 12500), (128512, 128580)) for c in range(a, b)]
    texts = ODD + ["".join(rng.choice(letters) for _ in range(80)) for _ in range(300)] + ["".join(rng.choice("aeinrst '") for _ in range(120)) for _ in range(300)]
    got = bpe.Encoder(bpe.load(PATH)).encode(texts)
    tokens = bpe.load(PATH)["tokens"]
    for text, ids in zip(texts, got):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert bpe.decode_ids(tokens, expected) == library.decode(expected, skip_special_tokens=False)


def test_short_and_long_words_agree():
    encoder = bpe.Encoder(bpe.load(PATH))
    rng = random.Random(4)
    words = [bytes(rng.choice(b"aeiourstlnd") for _ in range(rng.randint(1, bpe.SHORT))) for _ in range(500)]
    ids, sizes = encoder._encode_words(words)
    at = 0
    for word, n in zip(words, sizes):
        assert ids[at : at + n].tolist() == encoder._long(word).tolist()
        at += n


def test_forgetting_changes_nothing(monkeypatch):
    texts = [f"word{i} other{i * 7} thing" for i in range(300)]
    whole = bpe.Encoder(bpe.load(PATH)).encode(texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    small = bpe.Encoder(bpe.load(PATH))
    assert [x.tolist() for t in texts for x in small.encode([t])] == [x.tolist() for x in whole]


def test_encoded_and_decoded_columns(spark, documents, no_documents, library):
    tables = bpe.share(spark, PATH)
    rows = bpe.decoded(bpe.encoded(documents, tables), tables).collect()
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(documents, tables).collect()}
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), r.decoded)]
        assert (r.doc_id, len(ids), *sha) in digests
    assert bpe.encoded(no_documents, tables).collect() == []
    none = spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")
    assert bpe.decoded(none, tables).first().decoded is None


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_phrases(documents, no_documents):
    got = collections.Counter(tuple(r[:6]) for r in license_scan.scan(documents).collect())
    expected = collections.Counter()
    for r in documents.collect():
        w = license_words(r.text)
        hits = [(i, label) for label, p in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        places = [h[0] for h in hits]
        expected[r.doc_id, len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({h[1] for h in hits}))] += 1
    assert got == expected
    assert license_scan.scan(no_documents).collect() == []


def labels_of(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.labels for r in sorted(license_scan.scan(df, **more).collect(), key=lambda r: r.doc_id)]


def telling(word):
    return word.isdigit() or word in license_scan.FAMILY


def test_every_template_survives_one_edit_anywhere(spark):
    texts, want = [], []
    for label, template in license_scan.TEMPLATES:
        w = license_words(template)
        # Places where an edit leaves a k-gram on the outer side of every telling word.
        marks = [i for i, x in enumerate(w) if telling(x)]
        free = [i for i, x in enumerate(w) if not telling(x) and not any(m < 3 and i < 3 + m or m >= len(w) - 3 and i > m - 3 for m in marks)]
        for i in free:
            texts += [" ".join(w[:i] + ["foreign"] + w[i:]), " ".join(w[:i] + w[i + 1 :]), " ".join(w[:i] + ["foreign"] + w[i + 1 :])]
            want += [label] * 3
    found = labels_of(spark, [f"before it {t} and after" for t in texts])
    assert [(t, f) for t, f, label in zip(texts, found, want) if label not in f.split(",")] == []


def test_telling_words_must_be_those_of_the_template(spark):
    texts, want = [], []
    for label, template in license_scan.TEMPLATES:
        w = license_words(template)
        for i, x in enumerate(w):
            if telling(x):
                texts += [" ".join(w[:i] + ["9" if x.isdigit() else "other"] + w[i + 1 :]), " ".join(w[:i] + w[i + 1 :])]
                want += [label] * 2
    found = labels_of(spark, texts, phrases=[])
    assert [(t, f) for t, f, label in zip(texts, found, want) if label in f.split(",")] == []


def test_canonical_notices_have_one_label(spark):
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
    cc = "This work is licensed under {0} Creative Commons Attribution{1} International License. To view a copy of this license, visit the site."
    notices = {
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0': "apache-2",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at": "apache-2",
        gnu.format("", "3"): "gpl-3", gnu.format("", "2"): "gpl-2", gnu.format("Affero ", "3"): "agpl-3", gnu.format("Lesser ", "3"): "lgpl-3",
        gnu.format("Lesser ", "2.1"): "lgpl-2.1", cc.format("a", " 4.0"): "cc-by", cc.format("the", " 4.0"): "cc-by", cc.format("the", "-ShareAlike 4.0"): "cc-by-sa",
        cc.format("a", "-NonCommercial-NoDerivatives 4.0"): "cc-by-nc-nd", cc.format("a", "-NonCommercial 4.0"): "cc-by-nc",
        "Released and licensed under the GNU Affero General Public License, version 3": "agpl-3",
        "You are licensed under the GNU Library General Public License, version 2": "",
    }
    assert dict(zip(notices, labels_of(spark, list(notices)))) == notices


def test_spans_and_scores(spark):
    text = license_scan.TEMPLATES[0][1]
    w = text.split()
    rows = [(1, "intro words here " + text), (2, " ".join(w[:9] + ["really"] + w[9:20] + w[21:])), (3, " ".join(w[:8])), (4, "of this software and of this software and"), (5, text + " gap " * 9 + text)]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), templates=[("mit", text)]).collect()}
    assert [got[k].labels for k in (1, 2, 3, 4, 5)] == ["mit", "mit", "", "", "mit"]
    assert got[1].score == 1.0 and 0.9 < got[2].score < 1.0 and got[5].n_spans == 2 and got[1].n_base == 0


def test_too_short_template_is_refused(spark, documents):
    with pytest.raises(ValueError):
        license_scan.scan(documents, templates=[("x", "two words")])


def pages(spark):
    big = "<p>" + "grüße " * 300
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", big), (7, "u", "\r\n\r\nWARC/1.1 " * 200)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def archive_round_trip(spark, rows):
    folder = common.scratch(spark, "test-warc")
    whole = common.stage(warc.written(warc.assigned(rows), f"{folder}/a"), f"{folder}/am")
    single = common.stage(warc.normalised(warc.spread(whole), f"{folder}/b"), f"{folder}/bm")
    return whole, single, warc.read_back(warc.spread(single))


def test_archives_round_trip(spark):
    rows = pages(spark)
    whole, single, back = archive_round_trip(spark, rows)
    source = rows.collect()
    expected = collections.Counter()
    for r in source:
        payload = (r.html or "").encode()
        same = [x.page_id for x in source if x.html == r.html and x.page_id is not None]
        again = len(payload) >= 1000 and max(same) != r.page_id
        expected[r.page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", max(same) if again else None] += 1
    assert collections.Counter(tuple(r[:5]) for r in back.collect()) == expected
    assert sum(r.records for r in whole.collect()) == sum(r.records for r in single.collect()) == len(source)
    assert {r.url for r in back.collect()} >= {"http://a/2%0D%0AX: y"}
    assert archive_round_trip(spark, rows.limit(0))[2].collect() == []


def test_members_stand_alone(spark):
    _, single, _ = archive_round_trip(spark, pages(spark))
    for r in single.collect():
        data = open(r.path.removeprefix("file://"), "rb").read()
        for line in open(r.sidecar.removeprefix("file://")):
            offset, length = map(int, line.split(" ", 2)[:2])
            member = gzip.decompress(data[offset : offset + length])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")


def test_broken_streams_are_errors():
    item = warc.record(1, "u", b"x" * 3000, 3000, "0", "response", None)
    packed = gzip.compress(item * 3)
    assert len(list(warc.records(warc.inflated(_reader(packed), "f"), "f"))) == 3
    members = gzip.compress(item) + gzip.compress(item)
    assert len(list(warc.records(warc.inflated(_reader(members), "f"), "f"))) == 2
    for bad in (packed[:-20], b"not gzip at all", zlib.compress(item)):
        with pytest.raises(ValueError, match="f"):
            list(warc.records(warc.inflated(_reader(bad), "f"), "f"))
    with pytest.raises(ValueError):
        list(warc.records(iter([item[:-10]]), "f"))


def _reader(data):
    parts = iter([data[i : i + 7000] for i in range(0, len(data), 7000)])
    return lambda _: next(parts, b"")


def test_registered_queries_keep_every_row(spark):
    n = spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    assert queries.op7_gzip_normaliser(spark, SF_DIR).count() == n
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert queries.op10_rank_array_bpe(spark, SF_DIR).select(F.count_distinct("doc_id")).first()[0] == docs.count()
