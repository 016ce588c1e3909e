import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from censusflow.llm.packing import pack, pack_documents, patterns_for
from censusflow.llm.token_file import FrequencyTable, decode_block, encode_block, read_token_files, write_token_files
from censusflow.llm.tokenize import Encoder, tokenizer_path
from censusflow.llm.util import string_buffer

TEXTS = ["", "a", "  two  spaces\n\n\nlines ", "don't 'quote's WE'LL", "x　 y é  z    w", "ΑΣ ΑΣ. İstanbul <|endoftext|> x|y | z", "   ", "é ́a",
         "日本 語   q", "tab\tand\r\nreturn", "| || a | b", "\n", " \n ", "word " * 3000, "0123 45 6.7", "naïve café", "a b   c", "\x1c x \x85 y"]
FILES = [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "byte")]


def ids_of(enc, texts):
    return [e.ids for e in enc.tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("file,rule", FILES)
def test_ids_equal_the_library(spark, sf_dir, file, rule):
    enc = Encoder(tokenizer_path(file), rule)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rng = random.Random(1)
    texts += ["".join(rng.choice(" \n\tab|é'1. ") for _ in range(rng.randrange(40))) for _ in range(1500)]
    for _ in range(2):  # from an empty and from a full memory
        ids, n = enc.encode(*string_buffer(pa.array(texts)))
        at = np.append(0, np.cumsum(n))
        for k, want in enumerate(ids_of(enc, texts)):
            assert ids[at[k]:at[k + 1]].tolist() == want, texts[k][:60]


def test_byte_pieces_end_at_signs_digits_and_newlines():
    # "word,", "(word" and "word.\nword" were pieces of their own, each encoded anew
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"), "byte")
    enc.encode(*string_buffer(pa.array(["word word, (word; word2 word.\nword don't 'tis été,"])))
    assert sorted(enc.size.tolist()) == sorted(map(len, ids_of(enc, ["word", " word", ",", " (", ";", "2", ".", "\n", " don", "'t", " 'tis", " été"])))
    rng = random.Random(9)
    letters = [chr(c) for c in range(0xA0, 0x250)]
    texts = [f"a{c}1{c}'{c}s.{c}\n{c} {c}, {c}{c}9{c}A" for c in letters]
    some = [*" \n\n\t'.-<|019aZs", "'ll", "'re", "\n\n", "é", "ÿ", "ȿ", "×", "÷", "\u0301", "\u0660", "\xa0", "\u2028", "\x85", "日", "²"]
    texts += ["".join(rng.choice(some) for _ in range(rng.randrange(30))) for _ in range(20_000)]
    for _ in range(2):
        ids, n = enc.encode(*string_buffer(pa.array(texts)))
        at = np.append(0, np.cumsum(n))
        for k, want in enumerate(ids_of(enc, texts)):
            assert ids[at[k]:at[k + 1]].tolist() == want, texts[k]


SPECIAL = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|><|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|endoftext|>", "< |endoftext|>"]


@pytest.mark.parametrize("file,rule", FILES)
def test_special_tokens_equal_a_fresh_tokenizer(file, rule):
    from tokenizers import Tokenizer
    enc, fresh = Encoder(tokenizer_path(file), rule), Tokenizer.from_file(tokenizer_path(file))
    assert not any(c.isspace() for t in fresh.get_added_tokens_decoder().values() for c in t.content)
    gaps = ["", " ", "  ", "\n", " \n ", "é", "é ", " é", "|", " | "]
    texts = [f"one{a}{x}{b}two" for x in SPECIAL for a in gaps for b in gaps] + [f"{a}{x}{b}" for x in SPECIAL for a in gaps for b in gaps]
    texts += [" ".join([f"w{k}" for k in range(60)] + SPECIAL + [f"v{k}" for k in range(60)]), "one <|endoftext|> two"]
    rng = random.Random(4)
    texts += ["".join(rng.choice([*SPECIAL, *gaps, "a", "word", "'s"]) for _ in range(rng.randrange(12))) for _ in range(1500)]
    for _ in range(2):
        ids, n = enc.encode(*string_buffer(pa.array(texts)))
        at = np.append(0, np.cumsum(n))
        for k, want in enumerate(fresh.encode_batch(texts, add_special_tokens=False)):
            assert ids[at[k]:at[k + 1]].tolist() == want.ids, texts[k][:60]
    special = fresh.token_to_id("<|endoftext|>")
    assert special in ids[at[texts.index("one <|endoftext|> two")]:].tolist()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, length int, ids string").repartition(3)


ROWS = [(7, "some text here"), (3, None), (3, ""), (5, "word " * 9000), (None, "no id"), (7, "some text here"), (1, "é " * 10)]


def test_token_files_round_trip(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    enc = Encoder(path, "byte")
    rows = ROWS + [(100 + k, f"document {k} " * (k % 7)) for k in range(200)]
    blocks, table = write_token_files(docs(spark, rows), path, "byte", 2, block_ids=500, lanes=8, steps=4)
    assert blocks.count() >= 4
    got = sorted(read_token_files(blocks, table, keep_ids=True).collect(), key=lambda r: r.start)
    ids = {t: i + [2] for t, i in zip([t for _, t in rows], ids_of(enc, [t or "" for _, t in rows]))}
    at, seen = 0, []
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
        seen.append((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())))
    order = [-1 if i is None else i for i, _ in seen]
    assert order == sorted(order)
    assert sorted(seen, key=repr) == sorted(((i, tuple(ids[t])) for i, t in rows), key=repr)


def test_empty_table_of_documents(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    assert read_token_files(*write_token_files(docs(spark, []), path, "byte", 2)).collect() == []
    assert pack_documents(docs(spark, []), tokenizer_path("word_bpe_49k.json")).collect() == []


def test_blocks_decode_in_parts_and_detect_damage():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.zipf(1.3, 40_000), 60_000).astype(np.int64)
    table = FrequencyTable.from_counts(*np.unique(ids, return_counts=True))
    assert table.freq.sum() == 1 << table.bits
    freq, first, symbol = table.tables()
    for n in (0, 1, 127, 128, 1000, 40_000):
        block = encode_block(ids[:n], table.bits, freq, first, lanes=64, steps=16)
        assert (decode_block(block, freq, first, symbol) == ids[:n]).all()
    parts = [decode_block(block, freq, first, symbol, k) for k in range(-(-40_000 // (64 * 16)))]
    assert (np.concatenate(parts) == ids).all()
    for at in (0, 30, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            decode_block(bytes(bad), freq, first, symbol)


def test_packing_of_documents(spark):
    path = tokenizer_path("word_bpe_49k.json")
    enc = Encoder(path, "word")
    rng = random.Random(2)
    rows = ROWS + [(200 + k, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randrange(4000)))) for k in range(120)]
    rows = [(i, t) for i, t in rows if (i, t) not in ((7, "some text here"), (3, ""))] + [(7, "some text here")] * 2
    got = pack_documents(docs(spark, rows), path).collect()
    ids = {i: x + [1] for (i, _), x in zip(rows, ids_of(enc, [t or "" for _, t in rows]))}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    copies = {i: sum(j == i for j, _ in rows) for i, _ in rows}
    for i, n in copies.items():
        places = [k for a, b in by_doc[i] for k in range(a, a + b)]
        assert sorted(places) == sorted(list(range(len(ids[i]))) * n)
    for parts in by_seq.values():
        at = 0
        for a, b in sorted(parts):
            assert a == at
            at += b
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(by_seq) * 2048 - total < 0.02 * total + 2048


def test_hot_length_is_ranked_apart(spark):
    pieces = spark.range(3000).selectExpr("id AS doc_id", "0L AS start", "if(id % 3 = 0, 700L, id % 2048 + 1) AS length", "id AS ids_crc32")
    rows = pack(pieces).collect()
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert len(rows) == 3000 and max(used.values()) <= 2048


def test_patterns_cover_the_demand():
    rng = np.random.default_rng(1)
    for _ in range(30):
        size = np.unique(rng.integers(1, 65, rng.integers(1, 20)))
        demand = rng.integers(1, 60, len(size))
        plan = patterns_for(size, demand, 64)
        assert (sum(p * n for p, n in plan) == demand).all()
        assert all((p * size).sum() <= 64 and n > 0 for p, n in plan)
        least = -(-int((size * demand).sum()) // 64)
        assert sum(n for _, n in plan) <= 1.6 * least + len(size)
