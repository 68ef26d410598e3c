"""Byte pairs, conversations and spelling variants against plain versions of themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import stationlake.llm.spelling as spelling
from stationlake.llm import queries
from stationlake.llm.bpe import byte_pairs, decode_ids, encode_texts
from stationlake.llm.conversations import STEPS, Parse, damaged, repair_conversations, repair_rows, row_cell
from tests.compare import differences

FILE = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
TEXTS = [
    None,
    "",
    " ",
    "\n\n  x\t \n",
    "Don't you'll we've I'm 's 'S",
    "a" * 300 + "b" * 49,
    "the" * 40,
    "été À l'œuvre ½ Ⅷ ² ٣٤ 中文字 🙂🙂 é​  x",
    "end <|endoftext|> and<|endoftext|><|endoftext|>  more",
    "\x00\x01\x1c\x1d\x85﻿",
    "word " * 5000,
    "long " + "qzx" * 20000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_encoding_is_the_librarys(spark, library):
    rng = random.Random(7)
    pool = [chr(c) for c in range(0x250)] + list("́ 　 🙂中") + ["the", "ing", " an", "  "]
    texts = TEXTS + ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(2000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    rows = decode_ids(encode_texts(docs, FILE), FILE).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = np.frombuffer(row.ids, dtype="<u4").tolist()
        assert ids == library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.decoded == library.decode(ids, skip_special_tokens=False) == (texts[row.doc_id] or "")


def test_decoding_of_any_ids(library):
    rng = random.Random(3)
    tables = byte_pairs(FILE)
    for _ in range(300):
        ids = [rng.choice([rng.randrange(300), rng.randrange(50257)]) for _ in range(rng.randint(0, 30))]
        found = tables.decode(np.array(ids, dtype="<u4").tobytes()).decode("utf-8", "replace")
        assert found == library.decode(ids, skip_special_tokens=False)
    assert tables.decode(np.array([60000, 64], dtype="<u4").tobytes()) == library.decode([64]).encode()


def test_encoding_of_the_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.QUERIES["op11_byte_pairs"](spark, SF).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected = (
            len(ids),
            hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
        assert found[doc.doc_id][1:] == expected


def test_encoding_of_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert decode_ids(encode_texts(none, FILE), FILE).collect() == []


def cheapest(rows):
    """All repairs of (initial, fault) rows, the least (cost, audit)."""

    @cache
    def go(i, p, in_a_row):
        out = [(0, "")] if i == len(rows) and p in (0, 3) else []
        if in_a_row < 2:
            steps = [b for w in "ua" for a, b in STEPS[w] if a == p]
            out += [(3 + c, "I" + s) for b in steps for c, s in go(i, b, in_a_row + 1)]
        if i < len(rows):
            initial, fault = rows[i]
            out += [(4 + c, "D" + s) for c, s in go(i + 1, p, 0)]
            more = 3 if fault == "truncated" else 0
            for w in "sua" if fault not in ("blank", "duplicate") else "":
                for b in (b for a, b in STEPS[w] if a == p):
                    if initial == w:
                        out += [(more + c, "K" + s) for c, s in go(i + 1, b, 0)]
                    elif w != "s":
                        out += [(more + 3 + c, "R" + s) for c, s in go(i + 1, b, 0)]
        return out

    return min(go(0, 0, 0))


def test_parse_finds_the_cheapest_repair():
    rng = random.Random(3)
    faults = ["", "", "", "blank", "duplicate", "truncated"]
    for _ in range(400):
        rows = tuple((rng.choice("suaaux"), rng.choice(faults)) for _ in range(rng.randint(0, 5)))
        chart = Parse()
        for row in rows:
            chart.add(row_cell(*row))
        assert chart.best() == cheapest(rows)


def spaced(value):
    return " " if value is None else str(value)


def plain_repairs(rows):
    """The rows of op12, from (conv_id, turn, role, text), by the letter of its contract."""
    taken = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        role, text = spaced(role), spaced(text)
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        taken[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    space = " \t\n\x0b\x0c\r"
    out = {}
    for conv, these in taken.items():
        these.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, judged = set(), []
        for _, role, text in these:
            bare = text.strip(space)
            fault = "" if bare and bare[-1] in ".!?" else "truncated"
            fault = "duplicate" if (role, text) in seen else fault
            judged.append((role[:1], "blank" if not bare else fault))
            seen.add((role, text))
        cost, audit = cheapest(tuple(judged))
        left, repaired = iter(these), []
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else next(left)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if repaired and repaired[-1][0] == "u" else "user"
            repaired.append(f"{role}:{text}")
        turns = [t for t, _, _ in these if t is not None]
        count = Counter(fault for _, fault in judged)
        pairs = [a[0] + b[0] for a, b in zip(judged, judged[1:], strict=False)]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            count["blank"],
            count["duplicate"],
            count["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
            len(these),
        )
    return out


def test_conversations_against_a_plain_version(spark):
    rng = random.Random(11)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", "Why?", "", " \t", None, "a.\n ", "é!", "x ", "long. " * 300]
    rows = []
    for conv in [None, *range(150)]:
        for turn in range(rng.randint(1, 5)):
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles), rng.choice(texts)))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.selectExpr("*", "1 AS cost", "'x' AS audit")  # names that clash with the result's
    found = {r.conv_id: tuple(r)[1:7] + (r.audit, r.repaired_sha256, r.n_rows) for r in
             repair_conversations(damaged(frame)).select(
                 "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
                 "n_rows").collect()}
    expected = plain_repairs(rows)
    assert found == expected


def test_dropped_conversations_and_no_rows(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(dropped, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = repair_conversations(damaged(rows)).collect()
    assert (row.conv_id, row.cost, row.audit, row.gaps) == (dropped, 0, "", 0)
    assert row.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert repair_conversations(damaged(rows.limit(0))).collect() == []


def test_a_long_conversation(spark):
    """Thousands of rows in one conversation; the repair is legal and costs what its audit says."""
    rng = random.Random(5)
    rows = [("c", i, rng.choice(["user", "assistant"]), f"{i}." if i % 7 else f"{i}") for i in range(4000)]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    (row,) = repair_conversations(frame).collect()
    edited = repair_rows(frame).orderBy("place").collect()
    initials = "".join(r.role[0] for r in edited)
    assert re.fullmatch("(s?(ua)+)?", initials)
    assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in edited).encode()).hexdigest()
    price = {"K": 0, "R": 3, "D": 4, "I": 3}
    kept = [e for e in row.audit if e != "I"]
    cut_off = sum(3 for e, r in zip(kept, rows, strict=True) if e != "D" and not r[3].endswith("."))
    assert row.cost == sum(price[e] for e in row.audit) + cut_off


def test_conversations_against_sql(spark):
    rows, wrong = differences(spark, SF, queries.QUERIES["op12_conversations"], queries.ORACLES["op12_conversations"])
    assert rows and not wrong


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(count):
    out = {}
    for word, n in count.items():
        near = [(-m, other) for other, m in count.items() if one_edit(word, other)]
        best = min(near, default=(0, None))
        form = best[1] if best[1] is not None and -best[0] >= 10 * n else None
        out[word] = [form, None, n, len(near), -best[0] if form else None]
    for word in out:
        root = word
        while out[root][0]:
            root = out[root][0]
        out[word][1] = root
    return {w: tuple(v) for w, v in out.items()}


def plain_vocabulary(rows):
    count = Counter()
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 2}


@pytest.mark.parametrize("shard_words", [spelling.SHARD_WORDS, 5])
def test_variants_against_all_pairs(spark, monkeypatch, shard_words):
    """Also with every shard cut into blocks, and over an alphabet small enough for intervals of many words."""
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard_words)
    rng = random.Random(2)
    count = {"".join(rng.choices("abé÷", k=rng.randint(7, 9))): rng.choice([2, 3, 40, 700, 9000]) for _ in range(500)}
    stem = "internationally"
    count |= {stem: 10**6, stem + "s": 10**4, stem + "sx": 100, stem + "sxy": 2, "z" * 400: 30, "z" * 401: 3, "z" * 399: 2}
    words = spark.createDataFrame([*count.items(), (None, 3)], "word string, n long")
    found = {r.word: tuple(r)[1:] for r in spelling.spelling_variants(words).collect()}
    assert found == plain_variants(count)


def test_variants_of_documents_against_all_pairs(spark):
    rows = [
        (1, "Straße Über-allemal überallemal überallemale ÜBERALLEMAL " + "wonderful " * 60),
        (2, "wonderfull wonderfull wonderul wonderul x" + "y" * 3000 + " x" + "y" * 3000),
        (None, "wonderful" + " unknown" * 3),
        (4, None),
        (5, ""),
        (6, "ABCDEFG×ABCDEFG " * 50 + " short words only"),
        (6, "ABCDEFG×ABCDEFG " * 50),
    ]
    rows += [(i, "possible possibly invisible " * 3) for i in range(10, 120)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n int")
    count = plain_vocabulary(rows)
    found = spelling.spelling_variants(spelling.vocabulary(docs)).collect()
    assert len(count) > 8
    assert {r.word: tuple(r)[1:] for r in found} == plain_variants(count)
    assert spelling.spelling_variants(spelling.vocabulary(docs.limit(0))).collect() == []


def test_spelling_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = queries.QUERIES["op13_spelling"](spark, SF).collect()
    assert {r.word: tuple(r)[1:] for r in found} == plain_variants(plain_vocabulary(rows))
