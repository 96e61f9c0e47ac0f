"""Two tokenizers' alignment against a plain version that uses both libraries as they are."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerwatch.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"
A, B = queries.model_path(queries.BYTES), queries.model_path(queries.PIECES)
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def plain(texts):
    """Groups of (A ids, B ids) of each text."""
    one, two, code = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), alignment.byte_level()
    one.encode_special_tokens = True
    out = []
    for text in texts:
        groups = []
        if text:
            whole = (" " + text).encode()
            a = [(i, bytes(code[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()) for i in two.encode(text)]
            if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
                ends = []
                for side in (a, b):
                    at, found = 0, []
                    for _, x in side:
                        at += len(x)
                        found.append(at)
                    ends.append(found)
                at = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    to = [own.index(cut, k) + 1 for own, k in zip(ends, at)]
                    groups.append(tuple([i for i, _ in side[k:e]] for side, k, e in zip((a, b), at, to)))
                    at = to
        out.append(groups)
    return out


def expected(texts):
    every = plain(texts)
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in every]
    held = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for groups, own in zip(every, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        sums = (sum(n for (x, y), n in own.items() if held[x, y] == most[x]), sum(n * held[p] for p, n in own.items()))
        counts = (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()))
        out.append((*counts, *sums, hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


draw = random.Random(3)
AWKWARD = [
    None, "", " ", "  ", "\n", "a", "plain words here", "plain words here", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ mark", "x▁", "\x00\x01", "é" * 50, "日本語のテキスト😀🏳️‍🌈",
    " " * 700 + "x", "a" * 3_000, "tab\tand\r\nlines \n\n", "".join(chr(draw.randrange(0x20, 0x3000)) for _ in range(400)), "long words " * 4_000, "don't they're I'll 123456 1,000.5",
    "".join(draw.choice("abcdefgh  .,") for _ in range(9_000)), "�​  wide　space",
]


@pytest.mark.parametrize("lane, batch, block, pairs", [(1024, 1 << 20, 6 << 20, 1 << 20), (7, 3_000, 9_000, 5)])
def test_awkward_texts(spark, monkeypatch, lane, batch, block, pairs):
    for name, value in (("LANE", lane), ("BATCH_BYTES", batch), ("BLOCK_BYTES", block), ("PAIRS", pairs)):
        monkeypatch.setattr(alignment, name, value)
    # In this process: workers would not see other settings.
    import numpy as np
    import pyarrow as pa

    table = pa.table({"text": AWKWARD})
    groups, digests, found = [], [], []
    for part, _, own in alignment._batches(table, A, B):
        digests += own.digests()
        doc, pair, times = own.pairs()
        assert len(np.unique(doc * (1 << 50) + pair)) == len(pair)
        found += [Counter({(int(p) >> alignment.BITS, int(p) & ((1 << alignment.BITS) - 1)): int(t) for p, t in zip(pair[doc == k], times[doc == k])}) for k in range(len(part))]
        groups += own.n_groups.tolist()
    want = plain(AWKWARD)
    assert found == [Counter((x, y) for a, b in g for x in a for y in b) for g in want]
    assert groups == list(map(len, want)) and digests == [r[-1] for r in expected(AWKWARD)]


@pytest.mark.parametrize("n", [len(AWKWARD), 0])
def test_counts(spark, n):
    rows = [(i, t, "x", 1) for i, t in enumerate(AWKWARD[:n])]
    df = queries.workers_import(spark).createDataFrame(rows, "doc_id long, text string, row string, block int")
    out = alignment.linked_counts(df, A, B).select("row.doc_id", *COLUMNS).collect()
    assert [tuple(r)[1:] for r in sorted(out)] == expected(AWKWARD[:n])


def test_groups_as_lists(spark):
    df = queries.workers_import(spark).createDataFrame([(i, t) for i, t in enumerate(AWKWARD)], "doc_id long, text string")
    for r, want in zip(sorted(alignment.align_documents(df, A, B).collect(), key=lambda r: r.row.doc_id), plain(AWKWARD)):
        cuts = zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends)
        assert [(r.a_ids[a:b], r.b_ids[c:d]) for a, b, c, d in cuts] == want


def test_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SMALL, "documents").select("doc_id", "text").collect()}
    out = sorted(queries.op13_alignment(spark, SMALL).select("doc_id", *COLUMNS).collect())
    assert [r[0] for r in out] == sorted(texts)
    assert [tuple(r)[1:] for r in out] == expected([texts[i] for i in sorted(texts)])


def test_the_faster_encoder_gives_the_files_own_ids():
    own, fast = Tokenizer.from_file(A), alignment.ByteBpe(A)
    own.encode_special_tokens = True
    for low in range(0, 0x3000, 64):
        text = "".join(f" a{chr(c)}1{chr(c)} {chr(c)}.{chr(c)}{chr(c)}" for c in range(low, low + 64))
        assert fast.encode([text])[0].tolist() == own.encode(" " + text, add_special_tokens=False).ids
