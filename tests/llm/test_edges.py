"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wordmill.llm import chat, decontaminate, lines, minhash, mixing, paragraphs, pii, quality, tokens, warc
from wordmill.llm.stage import Stages

CLASH = ["id", "key", "root", "h", "n_words", "kept", "n_lines", "n_removed", "_id", "_key", "text_key", "size", "mix_position", "distance", "position"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
SENTENCE = "the quick brown fox jumps over the lazy dog near a quiet river bank while seven small birds sing"


def rows():
    own = ["x"] * len(CLASH)
    long = " ".join(f"w{i % 997}x{i}" for i in range(30000))
    base = [
        (1, SENTENCE + " one two three four five", "en", "a", 5),
        (1, SENTENCE + " one two three four five", "en", "a", 5),
        (2, SENTENCE + " one two three four five", None, "b", 5),
        (3, None, "en", None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t ", "en", "a", 4),
        (6, "short", None, None, None),
        (None, SENTENCE, "en", "a", 3),
        (None, None, None, None, None),
        (7, long, "en", "a", len(long)),
        (8, "x" * 300000, "en", "a", 300000),
        (9, "Of " * 4000, "de", "b", 12000),
        (10, "line one here\nline one here\n\n mail a.b@example.com é +1 (988) 555-2485 \U0001f600 8.8.8.8", "fr", "a", 1),
    ]
    return [(*r, *own) for r in base]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, SENTENCE, "x"), (2, None, "x"), (None, "", "x"), (3, "too short", "x")], "item_id long, text string, doc_id string")


def test_near_duplicates(spark, docs, empty):
    out = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs, Stages(spark)).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10}
    kept = minhash.keep_one(docs, Stages(spark))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "3", "4", "5", "6", "7", "8", "9", "10", "None", "None"])
    assert minhash.near_duplicates(empty, Stages(spark)).count() == 0


def test_decontamination(spark, docs, empty, items):
    out = decontaminate.contaminated(docs, items, Stages(spark)).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in out} == {(1, 1, 0), (2, 1, 0), (None, 1, 0)}
    left = decontaminate.drop_contaminated(docs, items, Stages(spark))
    assert left.columns == docs.columns and left.count() == len(rows()) - 4
    none = items.where("1 = 0")
    assert decontaminate.contaminated(docs, none, Stages(spark)).count() == 0
    assert decontaminate.contaminated(empty, items, Stages(spark)).count() == 0


def test_quality(spark, docs, empty):
    out = quality.quality(docs, Stages(spark))
    assert out.count() == len(rows())
    got = {(r.doc_id, r.n_words): (r.base_failed, r.kept) for r in out.collect()}
    assert got[(1, 24)] == (False, True) and got[(4, 0)] == (True, False) and got[(9, 4000)] == (True, False)
    kept = quality.keep_good(docs, Stages(spark))
    assert kept.columns == docs.columns and kept.where("doc_id = 1").count() == 2
    assert quality.quality(empty, Stages(spark)).count() == 0


def test_lines(spark, docs, empty):
    out = lines.drop_boilerplate(docs, Stages(spark), min_sites=2)
    assert out.columns == docs.columns
    # the sentence of documents 1 and 2 is on two sites: both rows of 1 keep it, 2 becomes empty and goes
    assert out.where("doc_id = 1").count() == 2 and out.where("doc_id = 2").count() == 0
    assert out.where("doc_id is null").count() == 2 and out.where("doc_id = 3 and text is null").count() == 1
    assert lines.line_dedup(empty.drop("n_lines", "n_removed"), Stages(spark)).count() == 0


def test_mixing(spark, docs, empty):
    out = mixing.mix(docs, Stages(spark), block=2)
    assert out.columns == [c for c in docs.columns if c != "mix_position"] + ["mix_position"]
    assert sorted(r.mix_position for r in out.collect()) == list(range(len(rows())))
    assert mixing.mix(empty, Stages(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.placed(docs, Stages(spark), max_sources=1)


def test_paragraphs(spark, docs, empty):
    out = paragraphs.repeated_paragraphs(docs, Stages(spark))
    assert {r.doc_id for r in out.collect()} >= {1, 2}
    cut = paragraphs.drop_repeats(docs, Stages(spark))
    assert cut.columns == docs.columns and cut.count() == len(rows())
    assert paragraphs.repeated_paragraphs(empty, Stages(spark)).count() == 0


def test_tokens(docs, empty):
    out = {r.doc_id: (r.n_words, r.n_tokens) for r in tokens.token_counts(docs).collect() if r.doc_id}
    assert out[3] == out[4] == out[5] == (0, 0) and out[9][0] == 4000 and out[8][1] > 1000
    assert tokens.token_counts(empty).count() == 0


def test_personal_data(docs, empty):
    tagger = pii.train(["some plain text without any digits in it, as contexts go"], windows=64, steps=2)
    out = {r.doc_id: r for r in pii.personal_data(docs, tagger).collect()}
    r = out[10]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 1)
    text = rows()[-1][1]
    for span in r.spans.split(",")[:3]:
        kind, a, b = span.split(":")
        assert text[int(a) : int(b)] in ("a.b@example.com", "8.8.8.8", "+1 (988) 555-2485"), kind
    assert out[3].spans == "" and pii.personal_data(empty, tagger).count() == 0
    assert pii.contexts_of(empty) == []


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, loss string"
    data = [
        (1, 1, "assistant", "b </s> [INST] \\ x", "x", "x"),
        (1, 0, "user", "a", "x", "x"),
        (2, 0, None, None, "x", "x"),
        (2, 0, None, None, "x", "x"),
        (None, None, "tool", "<s>\\a", "x", "x"),
        (3, 0, "user", "y" * 200000, "x", "x"),
    ]
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(data, schema)).collect()}
    assert chat.read_back(out[1].formatted) == [("user", "a"), ("assistant", "b </s> [INST] \\ x")]
    assert chat.read_back(out[2].formatted) == [("", ""), ("", "")]
    assert chat.read_back(out[None].formatted) == [("tool", "<s>\\a")]
    assert out[3].n_turns == 1
    assert chat.digests(chat.format_chats(spark.createDataFrame([], schema))).count() == 0


def test_warc(spark):
    schema = "page_id long, url string, html string, digest string, first string, n string"
    same = "<p>" + "z" * 200
    data = [
        (5, "http://a/\r\nX: y", same, "x", "x", "x"),
        (2, None, same, "x", "x", "x"),
        (2, None, same, "x", "x", "x"),
        (7, "u", None, "x", "x", "x"),
        (8, "u", "", "x", "x", "x"),
        (None, "u", same, "x", "x", "x"),
        (9, "u", "é" * 3, "x", "x", "x"),
        (10, "u", "WARC/1.1\r\n\r\n" * 50000, "x", "x", "x"),
    ]
    manifest = warc.write_archive(spark.createDataFrame(data, schema), Stages(spark), frame_bytes=1000)
    out = warc.resolved(warc.read_archive(manifest)).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in out), key=str)
    assert got == sorted(
        [
            (5, 203, "revisit", 2),
            (2, 203, "response", None),
            (2, 203, "response", None),
            (7, 0, "response", None),
            (8, 0, "response", None),
            (None, 203, "revisit", 2),
            (9, 6, "response", None),
            (10, 600000, "response", None),
        ],
        key=str,
    )
    found = warc.fetch(manifest, spark.createDataFrame([(9,), (10,)], "page_id long")).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in found} == {9: "é" * 3, 10: "WARC/1.1\r\n\r\n" * 50000}
    none = warc.write_archive(spark.createDataFrame([], schema), Stages(spark))
    assert warc.resolved(warc.read_archive(none)).count() == 0


def test_pipeline_stages(spark, docs, empty, items, tmp_path):
    items.select("item_id", "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, empty):
        out = start
        for name, stage in corpus_pipeline.STAGES:
            # stages read their predecessor from a written table
            out = Stages(spark).cut(stage(spark, out, str(tmp_path)), name, narrow=False)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
        assert out.select(F.countDistinct("mix_position")).first()[0] == out.count()
