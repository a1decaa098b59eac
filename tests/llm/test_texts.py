"""Licences, BPE, id files, language ID, packing, sharding, the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from cartwheel.llm import bpe, id_coder, id_files, language, licenses, packing, sharding, word_ids
from cartwheel.llm.license_rules import ANCHORS, RULES
from tests.llm.helpers import DOCS, LOWER, corpus, words

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
BYTE_JSON, WORD_JSON = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def reference(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(5)


# -- licences -----------------------------------------------------------------------------------

LICENCES = [
    (1, "Licensed under the Apache License, Version 2.0 (the \"License\")"), (2, "MIT License MIT  license\nmit-license"),
    (3, "GNU General Public License, version 3."), (4, "submit license; mit licenses"), (5, None), (6, ""), (7, "É mit license É"),
    (8, "released under CC BY-NC-SA 4.0. Licensed under CC BY-NC-SA 4.0"), (9, "the K mİt license"), (10, "..."), (11, "a"),
    (12, "SPDX-License-Identifier: MIT"), (13, "general\tpublic...LICENSE and Apache\x01License"), (1, "MIT license " * 3000)]


def test_licence_base_counts_and_labels(spark):
    got = licenses.license_digest(spark.createDataFrame(LICENCES, "doc_id long, text string")).collect()
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    for (doc_id, text), r in zip(LICENCES, got):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [(i, label) for i in range(len(found)) for p, label in phrases.items() if tuple(found[i:i + len(p)]) == p]
        base = sorted({label for _, label in places})
        assert (r.doc_id, r.n_words, r.n_base) == (doc_id, len(found), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(base) and set(base) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    labels = {r.doc_id: r.labels for r in got[:-1]}
    assert labels[1] == "apache,apache-2.0" and labels[3] == "gpl,gpl-3.0" and labels[12] == "mit"
    assert labels[8] == "cc-by-nc-sa-4.0" and labels[4] == labels[10] == ""


def test_licence_rules_are_sound(spark):
    anchor = re.compile("|".join(ANCHORS).replace("*+", "*"))
    assert len(RULES) > 200 and all(anchor.search(keyword) for _, _, keyword, _ in RULES)
    for _, rank, keyword, pattern in RULES:
        re.compile(pattern)
        assert rank in (1, 2, 3, 4)


_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n")
_ADVERTISING = ("3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
                "This product includes software developed by the organization.\n")
_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
          "derived from this software without specific prior written permission.\n")
_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
        "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
NOTICES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
    ("gpl-3.0", _GNU.format("", "3")), ("gpl-2.0", _GNU.format("", "2")), ("lgpl-2.1", _GNU.format("Lesser ", "2.1")),
    ("agpl-3.0", _GNU.format("Affero ", "3")),
    ("bsd-3-clause", _BSD + "3. " + _NAMES + _AS_IS), ("bsd-3-clause", _BSD + "   * " + "and so on " * 900 + _NAMES + _AS_IS),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"),
    ("isc", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted,"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"),
    ("wtfpl", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"),
    ("unlicense", "This is free and unencumbered software released into the public domain.")]


def test_full_notices_by_their_standard_texts(spark):
    others = [("bsd-4-clause", _BSD + _ADVERTISING + "4. " + _NAMES + _AS_IS), ("bsd-4-clause", _BSD + "and so on " * 900 + _ADVERTISING),
              ("bsd", _BSD + _AS_IS), ("bsd", (_BSD + _AS_IS) * 200)]
    rows = [(i, t, label) for i, (label, t) in enumerate(NOTICES + others)]
    rows.append((100, _BSD + _AS_IS + _BSD + "3. " + _NAMES, "bsd,bsd-3-clause"))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, want string")).collect()
    for r in got:
        labels = {d.label for d in r.licenses}
        assert set(r.want.split(",")) <= labels, (r.doc_id, r.labels)
        assert r.doc_id >= len(NOTICES) or (r.want, 4) in {(d.label, d["rank"]) for d in r.licenses}
        assert {x for x in labels if x.startswith("bsd")} <= set(r.want.split(",")), (r.doc_id, r.labels)
    assert {label for label, rank, *_ in RULES if rank == 4} == {label for label, _ in NOTICES}


def test_contained_detections_are_suppressed(spark):
    rules = [("inner", 2, "license b", "license b"), ("outer", 3, "license b", "a license b c"),
             ("weak outer", 1, "license b", "z a license b c y"), ("strong", 4, "license", "license")]
    found = licenses.scan_licenses(spark.createDataFrame([("z a license b c y", 1)], "text string, labels int"), rules).first()
    assert [(d.label, d["first"], d.end) for d in found.licenses] == [("weak outer", 0, 6), ("outer", 1, 5), ("strong", 2, 3)]
    assert found.labels_in == 1 and found.score == 1.0


# -- BPE ----------------------------------------------------------------------------------------

_PIECES = ["a", "the", "'s", "'l", "l", "'", "  ", " ", "\n", "\t", "é", "ß", "日", "本", "1", "22", "!!", "　", "🙂", "́", "½", "\x1c"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(_PIECES), min_size=1, max_size=300), st.integers(5, 60))
def test_tree_gives_what_the_library_gives(pieces, leaf):
    own, text, old = bpe.codec(RANKS, PATTERN), "".join(pieces), bpe.LEAF
    try:
        bpe.LEAF = leaf
        ids = own.encode(text)
        assert ids == own._library.encode_ordinary(text) and own.decode(ids) == text.encode()
    finally:
        bpe.LEAF = old


def test_long_runs_are_joined_by_tokens():
    rng, own = random.Random(5), bpe.codec(RANKS, PATTERN)
    for letters in ("abcdefghinorst", "日本語中文字人大", "0123456789", "-"):
        text = "".join(rng.choice(letters) for _ in range(20_000))
        assert own.encode(text) == own._library.encode_ordinary(text)


def test_bpe_digest(spark, docs):
    tokenizer = reference(BYTE_JSON)
    got = Counter(tuple(r) for r in bpe.bpe_digest(docs, RANKS, PATTERN).collect())
    want: Counter = Counter()
    for doc_id, text, *_ in corpus():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4")
        want[(doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert got == want
    clash = bpe.encode_documents(spark.createDataFrame([(1, "a", 5)], "doc_id long, text string, ids int"), RANKS, PATTERN)
    assert clash.columns == ["doc_id", "ids_in", "ids"] and clash.first().ids_in == 5
    assert bpe.bpe_digest(spark.createDataFrame([], DOCS), RANKS, PATTERN).count() == 0


# -- id files -----------------------------------------------------------------------------------

@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65535) | st.integers(0, 3), max_size=300))
def test_blocks_round_trip(ids):
    assert list(id_coder.decode_blocks(id_coder.encode_blocks(np.array(ids, "<u4")))) == ids


def test_blocks_compress_reset_and_notice_damage():
    ids = np.tile(np.arange(50), 400)
    blocks = id_coder.encode_blocks(ids)
    assert sum(map(len, blocks)) < len(ids) / 4
    assert list(id_coder.decode_blocks(blocks[2:3])) == list(ids[2 * id_coder.BLOCK:3 * id_coder.BLOCK])
    damaged = bytearray(blocks[0])
    damaged[len(damaged) // 2] ^= 8
    for block in (bytes(damaged), b"nothing", blocks[0][:40]):
        with pytest.raises(ValueError):
            id_coder.decode_blocks([block])
    with pytest.raises(ValueError):
        id_coder.encode_blocks(np.array([1 << 16]))


def test_words_are_encoded_as_by_the_library():
    rng, own, tokenizer = random.Random(3), word_ids.WordTokenizer(WORD_JSON), reference(WORD_JSON)
    signs = [chr(c) for c in [*range(9, 14), *range(28, 0x180), *range(0x2010, 0x2030)]] + ["'s", " the", "<|endoftext|>", "日", "é"]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))
        assert own.encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_id_files(spark, docs):
    tokenizer = reference(WORD_JSON)
    rows = [tuple(r) for r in id_files.id_file_digest(docs, WORD_JSON).collect()]
    want, total = Counter(), 0
    for doc_id, text, *_ in corpus():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want[(doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
        total += len(ids)
    assert Counter((d, n, c) for d, _, n, c in rows) == want
    rows.sort(key=lambda r: r[1])
    assert [r[1] for r in rows] == list(np.cumsum([0, *(r[2] for r in rows)])[:-1]) and rows[-1][1] + rows[-1][2] == total
    known = [r[0] for r in rows if r[0] is not None]
    assert known == sorted(known) and [r[0] for r in rows[:2]] == [None, None]
    assert id_files.id_file_digest(spark.createDataFrame([], DOCS), WORD_JSON).count() == 0


# -- language -----------------------------------------------------------------------------------

def sentences(rng: random.Random, stems: str, n: int) -> str:
    return " ".join("".join(rng.choice(stems.split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_held_out_accuracy(spark):
    rng = random.Random(1)
    stems = {"aa": "ing the th er on wh", "bb": "sch ein ung ßt der", "cc": "é aux eau qu la"}
    rows = [(i, sentences(rng, stems[lang], rng.randint(5, 80)), lang, "s", 1) for i in range(400) for lang in [("aa", "bb", "cc")[i % 3 if i % 2 else 0]]]
    rows += [(1000, None, "aa", "s", 0), (1001, "", "aa", "s", 0), (1002, "123 !!", "bb", "s", 0), (None, "the ing", None, None, None),
             (1003, sentences(rng, stems["bb"], 60_000), None, "s", 1), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, DOCS)
    got = language.language_digest(frame).collect()
    assert len(got) == len(rows)
    right = 0
    for (doc_id, text, lang, *_), r in zip(rows, got):
        assert r.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if doc_id in (1000, 1001, 1002):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif lang and r.held_out:
            right += r.lang_pred == lang
            assert r.lang_pred in stems
    held = sum(r.held_out for r in got if r.doc_id is not None and r.doc_id < 1000)
    assert right >= 0.97 * held and {r.doc_id: r.lang_pred for r in got}[1003] == "bb"
    unlabelled = spark.createDataFrame([(1, "words", None, "s", 1)], DOCS)
    assert language.language_digest(unlabelled).first().lang_pred == "und"
    assert language.identify(frame.withColumnRenamed("lang", "score").limit(1), None).columns[-3:] == ["n_chars", "lang_pred", "score"]
    assert language.language_digest(frame.filter("false")).count() == 0


def test_copies_and_long_texts_leave_no_language_out(spark):
    rng = random.Random(3)
    few = [(sentences(rng, "ing the th er on wh", 9), "aa") for _ in range(5)]
    hot = spark.range(40_000).selectExpr("'the ing on' AS text", "'aa' AS lang")
    long = [("12 " * 9000 + sentences(rng, "sch ein ung", 9), "bb"), (sentences(rng, "sch ein ung", 9000), "bb")]
    frame = hot.unionByName(spark.createDataFrame(few + long + [("123", "cc")], "text string, lang string"))
    model = language.fit(frame)
    assert model.languages == ("aa", "bb")
    mine = spark.createDataFrame([(few[0][0],), ("ein schung ung",), ("the ing",)], "text string")
    assert [r.lang_pred for r in language.identify(mine, model).collect()] == ["aa", "bb", "aa"]
    again = language.fit(frame.repartition(7))
    assert np.array_equal(model.places, again.places) and np.allclose(model.weights, again.weights)


@pytest.mark.parametrize("landmarks", [400, 60])
def test_every_label_is_learned(spark, monkeypatch, landmarks):
    """More labels than landmarks, and more than any list of frequent ones would hold."""
    monkeypatch.setattr(language, "ALL_LANDMARKS", landmarks)
    rng = random.Random(9)
    stems = {f"l{i:03d}": " ".join("".join(chr(0x61 + rng.randrange(26)) for _ in range(3)) for _ in range(4)) for i in range(150)}
    rows = [(name, sentences(rng, stems[name], 40)) for name in stems for _ in range(3 if name > "l010" else 30)]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.languages == tuple(sorted(stems))
    fresh = [(name, sentences(rng, stems[name], 60)) for name in stems]
    got = language.identify(spark.createDataFrame(fresh, "lang string, text string"), model).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= (145 if landmarks == 400 else 50)     # landmarks of few labels tell the others apart less well


def test_kernel_sees_whole_texts():
    assert {int(g) for g in language._present("a" * 300_000 + "zq")} >= {int(g) for g in language._present("azq")[:0]}
    tail = set(language._present("zq")) - set(language._present("a"))
    assert tail & set(language._present("a" * 300_000 + "zq "))


# -- packing ------------------------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [2048, 64])
def test_packing(spark, docs, capacity):
    tokenizer = reference(BYTE_JSON)
    pieces = packing.cut_documents(docs.filter("doc_id not in (1, 7)"), BYTE_JSON, PATTERN, capacity)
    rows = packing.pack_pieces(pieces, capacity).collect()
    texts: dict = {}
    for doc_id, text, *_ in corpus():
        texts[(doc_id, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]))] = 1
    assert all(r.length <= capacity and len(r.ids) == 4 * r.length for r in rows)
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, own in by_doc.items():
        if doc_id is None or doc_id == 3:      # repeated ids: their pieces are told apart by place only
            continue
        own.sort(key=lambda r: r.start)
        ids = np.frombuffer(b"".join(r.ids for r in own), "<u4")
        assert (doc_id, tuple(ids)) in texts and [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1])
        assert all(r.doc_tokens == len(ids) for r in own)
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        parts.sort()
        ends = np.cumsum([0, *(n for _, n in parts)])
        assert [o for o, _ in parts] == list(ends[:-1])
        assert ends[-1] == capacity or ends[-1] & (ends[-1] - 1) == 0       # nothing is padded
    whole = packing.sequences(packing.pack_pieces(pieces, capacity)).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(r.length for r in rows)


def test_packing_edges(spark):
    assert packing.packing_digest(spark.createDataFrame([], DOCS), BYTE_JSON, PATTERN).count() == 0
    one = packing.packing_digest(spark.createDataFrame([(None, None)], "doc_id long, text string"), BYTE_JSON, PATTERN).first()
    assert (one.doc_id, one.start, one.length, one.doc_tokens, one.sequence_id, one.offset) == (None, 0, 1, 1, 0, 0)
    with pytest.raises(ValueError):
        packing.cut_documents(spark.createDataFrame([], DOCS), BYTE_JSON, PATTERN, 100)


# -- sharding -----------------------------------------------------------------------------------

def test_shards(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, DOCS).coalesce(2)
    got = sharding.shard_digest(frame, shards=5, bucket_bytes=4000).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    places: dict = {}
    for r in got:
        places.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
        assert 0 <= r.shard < 5 and r.grown_shard in (r.shard, 5) and r.law == "key"
    assert all(len(p) == 1 for p in places.values())          # the key decides
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    again = sharding.shard_digest(frame, shards=5, bucket_bytes=4000).collect()
    key = lambda r: (r.shard, r.slot)
    assert sorted(got, key=key) == sorted(again, key=key)


def test_shards_are_shuffled_and_keep_all_columns(spark):
    frame = spark.createDataFrame([(i, f"t{i}", {"a": i}, i) for i in range(4000)], "doc_id long, text string, m map<string,int>, slot long")
    out = sharding.shard_documents(frame, shards=2, bucket_bytes=1 << 20)
    assert out.columns == ["doc_id", "text", "m", "slot_in", "shard", "bucket", "place", "slot"]
    for shard in (0, 1):
        order = [r.doc_id for r in out.filter(f"shard = {shard}").orderBy("slot").collect()]
        assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.1
    grown = {r.doc_id: r.shard for r in sharding.shard_documents(frame, shards=3).collect()}
    moved = [r.doc_id for r in out.collect() if grown[r.doc_id] != r.shard]
    assert 0 < len(moved) < 2000 and all(grown[d] == 2 for d in moved)
    assert sharding.shard_documents(frame.filter("false")).count() == 0


def test_a_hot_key_gets_more_buckets(spark):
    frame = spark.createDataFrame([(None, "x" * 100)] * 3000 + [(i, "y") for i in range(100)], "doc_id long, text string")
    out = sharding.shard_documents(frame, shards=4, bucket_bytes=30_000)
    sizes = [r["count"] for r in out.groupBy("shard", "bucket").count().collect()]
    assert max(sizes) < 500 and sum(sizes) == 3100


# -- pipeline -----------------------------------------------------------------------------------

def test_unlabelled_documents_stay(spark):
    rows = [(1, "some words", None, "s", 10), (2, "ß", None, "s", 1), (3, "123 !", None, "s", 5), (4, "", None, "s", 0), (5, None, None, "s", 0)]
    got = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(tuple(r) for r in got.collect()) == rows[:2]


def test_stages_hand_on_documents(spark):
    rng = random.Random(2)
    long = [words(rng, 60) for _ in range(30)]
    rows = [(i, "\n".join([words(rng, 8), t]), "en", "s", 1) for i, t in enumerate(long)]
    rows += [(100, rows[0][1], "en", "s", 1), (101, None, "en", "s", 1), (102, "123", "en", "s", 1), (103, words(rng, 5), "en", "s", 1)]
    near = rows[1][1].replace(" ", "  ", 1).split(" ")
    near[40] = "changed"
    rows.append((104, " ".join(near).replace("\n", " "), "en", "s", 1))
    docs, kept = spark.createDataFrame(rows, DOCS), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settled(stage(spark, docs, ""), "test-stage")
        kept.append({r.doc_id for r in docs.collect()})
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    everything = {r[0] for r in rows}
    assert kept[0] == everything - {101, 102}
    assert kept[1] == kept[0] - {100}                  # every line of it stands in document 0
    assert kept[2] == kept[1] - {104}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in last} == kept[2]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], DOCS), "").count() == 0
