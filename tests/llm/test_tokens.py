"""Token counts, packing and the token archive against the libraries themselves."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewloom.llm import archive, packing, piece_counts, tokens
from reviewloom.llm.staging import shared_path

ODD_TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \n  b\n", "\t\x00 é", "don't we'll I'M", "x" * 3000, "ab" * 900, "a" * 77,
    " " * 70 + "x", "▁ ▁▁x", "é" * 50, "日本語 テキスト。", "fin. Next,line;one:two!three?", " x   y 　z", "\x1c \x1f a\x85b",
    "🙂🙂 smile", "é accents ä", "1234567 89.5,3", "<|endoftext|> <|startoftext|>x", "a<|endoftext|>b <|end", "<s> </s><unk>",
    "ΟΔΟΣ Σ İ ǅ", "... !!! ???", "foo<", "| a | b |\n|--|--|", "tab\tsep\r\nwin",
]


def mixed_texts(n=150, seed=3):
    draw = random.Random(seed)
    parts = ["the", "Thing", " ", "  ", "\n", ".", ",", "é", "ü", "123", "ing", "'s", "▁", " ", "🙂", "<|", "|>", "er", "-", "\t", "oo"]
    return ["".join(draw.choice(parts) for _ in range(draw.randrange(40))) for _ in range(n)]


TEXTS = ODD_TEXTS + mixed_texts()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_the_library(name):
    path = public_tokenizers.path(name)
    expected = [x.ids for x in Tokenizer.from_file(path).encode_batch(TEXTS, add_special_tokens=False)]
    encoder = tokens.ChunkEncoder(path)
    for _ in range(2):  # the second time from the store
        ids, first = encoder(pa.array(TEXTS))
        assert [ids[b:e].tolist() for b, e in zip(first, first[1:], strict=False)] == expected
    assert encoder(pa.array([], pa.string()))[1].tolist() == [0]


def test_a_full_store_starts_anew(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokens, "_KEPT_CHUNKS", 20)
    encoder = tokens.ChunkEncoder(path)
    whole = Tokenizer.from_file(path)
    for text in TEXTS:
        assert encoder(pa.array([text]))[0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_piece_counts_equal_the_library():
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = TEXTS + [" " * n + "word" for n in range(1, 90)] + ["a" + " " * n for n in range(90)]
    counter = piece_counts.PieceCounter(path)
    assert counter(pa.array(texts)).tolist() == [len(x) for x in model.encode(texts)]
    assert counter(pa.array([], pa.string())).tolist() == []


def test_token_counts_column(spark):
    rows = [(1, None, "x"), (None, "", None), (3, "two words", "y"), (3, "two words", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = piece_counts.token_counts(df, public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(r["n_tokens"] for r in got.collect()) == [0, 0, 2, 2]
    assert got.columns == df.columns
    assert piece_counts.token_counts(df.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def documents(spark, texts, schema="doc_id long, text string, row string, ids string, part int"):
    return spark.createDataFrame([(i, t, "r", None, 1) for i, t in enumerate(texts)], schema).repartition(3)


def test_pieces_hold_every_id_once(spark):
    texts = [None, *TEXTS, "word " * 5000, "again", "again"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(documents(spark, texts), path, 0, length=128)
    rows = [r.asDict(recursive=True) for r in pieces.collect()]
    whole = Tokenizer.from_file(path)
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r["row"]["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and 4 * r["length"] == len(r["ids"]) > 0
        assert r["row"]["row"] == "r"
    for i, text in enumerate(texts):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        found = sorted(by_document[i], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in found) == ids
        assert {r["doc_tokens"] for r in found} == {len(ids) // 4}
    for number, found in by_sequence.items():
        found.sort(key=lambda r: r["offset"])
        at = 0
        for r in found:
            assert r["offset"] == at
            at += r["length"]
        assert at == 128 or number == len(by_sequence) - 1
    padded = packing.sequences(pieces, 7, 128).collect()
    for r in padded:
        n = r["n_tokens"]
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == (n if n & (n - 1) == 0 else 128) and (ids[n:] == 7).all()


def test_packing_an_empty_table(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(documents(spark, ["x"]).limit(0), path, 0).count() == 0


def test_archive_round_trip(spark):
    texts = [None, *TEXTS, "same", "same"]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id"), (6, "repeated id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    vocabulary, path = public_tokenizers.path("word_bpe_49k.json"), shared_path(spark, "test-archive")
    manifest = archive.write_archive(df, path, vocabulary, 2, partitions=5)
    read = sorted(archive.read_archive(manifest, path).collect(), key=lambda r: (r["part"], r["frame"]))
    whole = Tokenizer.from_file(vocabulary)
    ids = {
        (i, t): np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes() for i, t in rows
    }
    assert [r["doc_id"] or -1 for r in read] == sorted(r["doc_id"] or -1 for r in read)
    start = 0
    for r in read:
        assert r["start"] == start
        assert r["ids_crc32"] in {zlib.crc32(v) for (i, _), v in ids.items() if i == r["doc_id"]}
        start += r["n_tokens"]
    assert start == sum(len(v) // 4 for v in ids.values())

    wanted = spark.createDataFrame([(9,), (30,), (10**6,)], "doc_id long")
    got = {r["doc_id"]: bytes(r["ids"]) for r in archive.read_documents(manifest, path, wanted).collect()}
    assert got == {i: ids[(i, t)] for i, t in rows if i in (9, 30)}

    system, root = pyarrow.fs.FileSystem.from_uri(path)
    name = manifest.filter("n_documents > 2").first()["file"]
    with system.open_input_file(f"{root}/{name}") as file:
        reader = archive.ArchiveReader(file)
        plain = b"".join(reader.frames())
        assert reader.frame(1) == plain[reader.entries["size"][0] :][: reader.entries["size"][1]]
    with system.open_input_file(f"{root}/{name}") as file:  # a reader that knows nothing of the tables
        assert zstandard.ZstdDecompressor().stream_reader(file.read(), read_across_frames=True).read() == plain


def test_damage_is_noticed(tmp_path):
    system, root = pyarrow.fs.FileSystem.from_uri(str(tmp_path))
    writer = archive.ArchiveWriter(system.open_output_stream(f"{root}/a", compression=None))
    writer.add(1, bytes(range(200)))
    writer.close()
    data = bytearray((tmp_path / "a").read_bytes())
    data[-9 - 4] ^= 1  # the checksum in the table
    (tmp_path / "a").write_bytes(data)
    with system.open_input_file(f"{root}/a") as file, pytest.raises(ValueError, match="damaged"):
        archive.ArchiveReader(file).frame(0)


def test_empty_archive(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = shared_path(spark, "test-archive")
    assert archive.archive_of(spark, df, path, public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def test_counts_do_not_depend_on_batches(spark):
    df = documents(spark, TEXTS).select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    one = {r["doc_id"]: r["n_tokens"] for r in piece_counts.token_counts(df.coalesce(1), path).collect()}
    many = {r["doc_id"]: r["n_tokens"] for r in piece_counts.token_counts(df.repartition(9, F.col("doc_id")), path).collect()}
    assert one == many


def test_texts_of_rearranged_bytes(spark):
    """Words that collide under polynomials modulo 2**64 keep their own ids and counts."""

    parity = [bin(i).count("1") % 2 for i in range(2048)]
    for a, b in ("ab", "in"):
        texts = ["".join(a if p else b for p in parity), "".join(b if p else a for p in parity)]
        for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
            path = public_tokenizers.path(name)
            ids, first = tokens.ChunkEncoder(path)(pa.array(texts))
            expected = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
            assert [ids[x:y].tolist() for x, y in zip(first, first[1:], strict=False)] == expected
        path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        assert piece_counts.PieceCounter(path)(pa.array(texts)).tolist() == [len(model.encode(t)) for t in texts]
