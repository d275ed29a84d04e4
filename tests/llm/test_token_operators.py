"""Fill-in-the-middle, cross-tokenizer alignment and byte-level BPE."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from meterline.llm import alignment, byte_bpe, fill_in_middle
from meterline.llm.oracle import ORACLE
from meterline.llm.queries import PIECES, QUERIES, TOKENIZER, VOCABULARY
from tests.conftest import SF, SF_SMALL, assert_same

P = pytest.importorskip("public_tokenizers")
FILES = P.path(VOCABULARY), P.PATTERN

ODD_TEXTS = ["", " ", "a", "<P>", "a <S> b", "x < P>", "<", "P>", "\n\n\n", "é你 \U0001f600́ ab", "a▁b", "<s></s><unk><|endoftext|><0x41>",
             "\x00x\x00", "word" * 3000, "A" * 7001, " " * 5000, "0123456789" * 500, "=-" * 700, "it's we'll I'D", "  　x"]


def random_texts(n, seed):
    r = random.Random(seed)
    letters = ["ab", "acgt", "etaoin shrdlu", "A", "é你ab ", " \n\t", "0123456789 ", "=-_/*<>PSM", "\U0001f600中Ж "]
    return ["".join(r.choice(a) for _ in range(r.choice((3, 30, 300, 1500)))) for a in (r.choice(letters) for _ in range(n))]


def table_of(spark, path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


# --- fill in the middle

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def fim_by_units(doc_id, text):
    units = UNIT.findall(text)
    n = len(units)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fim_against_sql(spark, duck):
    assert_same(QUERIES["op11_learned_rank_fim"](spark, SF), duck(), ORACLE["op11_learned_rank_fim"])


def test_fim_against_plain_units(spark, tmp_path):
    texts = ODD_TEXTS + random_texts(200, 1) + ["ends < ", "<" * 50, "<<P", "S>" * 30] * 5
    rows = QUERIES["op11_learned_rank_fim"](spark, table_of(spark, tmp_path, texts)).collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {(i, *fim_by_units(i, t)[:4], sha(fim_by_units(i, t)[4]), sha(t)) for i, t in enumerate(texts)}
    assert {tuple(r) for r in rows} == want and {r["form"] for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("text", ["a" * 90_000 + " " * 5_000 + "a b " * 3_000 + "z" * 300, " " * 300_000, "word and " * 40_000, "x", ""])
def test_rank_index_is_exact_and_bounded(text):
    offsets = fill_in_middle.boundaries(text)
    assert offsets.tolist() == [0] + np.cumsum([len(u) for u in UNIT.findall(text)]).tolist()
    index = fill_in_middle.learned(offsets)
    for s, start in enumerate(index.starts):
        end = index.starts[s + 1] if s + 1 < len(index.starts) else len(offsets)
        ranks = np.arange(start, end)
        assert (index.predicted(s, ranks) + index.residuals[start:end] == offsets[start:end]).all()
    assert np.abs(index.residuals.astype(int)).max() <= fill_in_middle.ERROR + 1 and len(index.starts) <= 8
    assert all(index.offset(k) == offsets[k] for k in range(0, len(offsets), max(1, len(offsets) // 200)))


def test_fim_of_odd_rows(spark, odd_docs, no_docs, clashing):
    rows = fill_in_middle.fill_in_middle(clashing).collect()
    assert len(rows) == odd_docs.count() and fill_in_middle.fill_in_middle(no_docs).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["n"], by_id[1]["form"], by_id[1]["output"]) == (0, "plain", "")
    assert by_id[4]["n"] == 160_000 and 2**60 + 1 in by_id
    assert len({r["output"] for r in rows if r["doc_id"] == 5}) == 1


# --- byte-level BPE

def tiktoken_of():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.coder(*FILES).ranks, special_tokens={})


def test_tokens_encode_to_themselves():
    assert byte_bpe.coder(*FILES).check_vocabulary() == []


def test_bpe_against_the_library(spark, documents):
    enc = tiktoken_of()
    rows = {r["doc_id"]: r for r in QUERIES["op13_monoid_bpe"](spark, SF).collect()}
    docs = documents.select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for r in docs:
        ids = enc.encode_ordinary(r["text"] or "")
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == len(ids) and got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()


def test_bpe_products_against_the_library():
    coder, enc = byte_bpe.coder(*FILES), tiktoken_of()
    for text in ODD_TEXTS + random_texts(400, 2):
        ids = coder.encode(text)
        assert ids == enc.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_product_is_associative_and_exact_at_every_cut():
    coder = byte_bpe.coder(*FILES)
    for text in ("internationalisation", "tokentokentoken", "aaaaaaaaaaaaaaaaaaaaa", "undeniablyunbelievable", "=" * 37):
        data = text.encode()
        whole = coder.leaf(data)
        for k in range(len(data) + 1):
            assert coder.product(coder.leaf(data[:k]), coder.leaf(data[k:])) == whole


def test_bpe_of_very_long_matches():
    coder = byte_bpe.coder(*FILES)
    for text in (" " * 3_000_000, "a" * 300_000, "".join(random.Random(5).choice("acgt") for _ in range(100_000)), "\n" * 200_000):
        assert coder.decode(coder.encode(text)) == text.encode()
    dna = "".join(random.Random(6).choice("acgt") for _ in range(50_000))
    assert coder.encode(dna) == tiktoken_of().encode_ordinary(dna)


def test_bpe_of_odd_rows(spark, odd_docs, no_docs, clashing):
    rows = byte_bpe.decode(byte_bpe.encode(clashing, *FILES), *FILES).collect()
    assert len(rows) == odd_docs.count() and byte_bpe.encode(no_docs, *FILES).count() == 0
    texts = Counter((r["doc_id"], r["text"] or "") for r in odd_docs.collect())
    assert Counter((r["doc_id"], bytes(r["decoded"]).decode()) for r in rows) == texts
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}


# --- alignment

def aligned_by_sets(text, both):
    """(n_a, n_b, groups): plain walk over both token lists."""
    if not text:
        return 0, 0, []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    whole = (" " + text).encode()
    bytes_a, bytes_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return 0, 0, []
    ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
    groups, lo = [], 0
    for end in sorted(set(ends_a) & set(ends_b)):
        groups.append(([i for i, e in zip(a, ends_a) if lo < e <= end], [i for i, e in zip(b, ends_b) if lo < e <= end]))
        lo = end
    return len(a), len(b), groups


def alignment_by_sets(texts):
    both = alignment.aligner(P.path(TOKENIZER), P.path(PIECES))
    held, per = Counter(), []
    for text in texts:
        n_a, n_b, groups = aligned_by_sets(text, both)
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(links.keys())
        per.append((n_a, n_b, groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for n_a, n_b, groups, links in per:
        digest = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(digest.encode()).hexdigest() if groups else ""))
    return out


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_of_all_documents(spark):
    rows = QUERIES["op12_galloping_alignment"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    want = alignment_by_sets([r["text"] for r in docs])
    assert sorted((r["doc_id"], *(r[c] for c in ALIGNED)) for r in rows) == sorted(
        (d["doc_id"], *w) for d, w in zip(docs, want))


def test_alignment_of_odd_texts(spark, tmp_path, monkeypatch):
    texts = [t.replace("　", "") for t in ODD_TEXTS] + random_texts(120, 3) + ["the same words, the same links"] * 40
    want = alignment_by_sets(texts)
    rows = QUERIES["op12_galloping_alignment"](spark, table_of(spark, tmp_path, texts)).collect()
    assert {(r["doc_id"], *(r[c] for c in ALIGNED)) for r in rows} == {(i, *w) for i, w in enumerate(want)}
    monkeypatch.setattr(alignment, "HOT_PAIRS", 20)  # few pairs broadcast, most shuffled
    again = QUERIES["op12_galloping_alignment"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_ids_by_ranks_are_those_of_the_json_file(documents):
    fast = alignment.aligner(P.path(TOKENIZER), P.path(PIECES), FILES)
    texts = [" " + (r["text"] or "") for r in documents.collect()] + ODD_TEXTS + random_texts(300, 4)
    texts += [f"a{chr(c)}b{chr(c)}1{chr(c)} !{chr(c)}! {chr(c)} " for c in range(0x20, 0x3000)] + [" " * 600_000 + "x"]
    for lo in range(0, len(texts), 64):
        part = texts[lo:lo + 64]
        assert fast.ids_a(part) == [e.ids for e in fast.a.encode_batch(part, add_special_tokens=False)]


@pytest.mark.parametrize("stretch", [1, 3, 512])
def test_galloping_against_sets(monkeypatch, stretch):
    monkeypatch.setattr(alignment, "STRETCH", stretch)
    rng = np.random.default_rng(0)
    for n, m in ((1, 1), (1, 500), (500, 1), (40, 3000), (700, 800)):
        a, b = (np.unique(rng.integers(0, 4000, k)) for k in (n, m))
        in_a, in_b = alignment.common_ends(a, b)
        both = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[in_a].tolist() == both and b[in_b].tolist() == both


def test_wide_groups_are_counted_by_distinct_ids(monkeypatch):
    a, b = np.array([5, 5, 7, 5, 9]), np.array([1, 2, 1, 3])
    ends = np.array([3, 4]), np.array([2, 3])
    plain = alignment.linked(a, b, *ends)
    monkeypatch.setattr(alignment, "WIDE", 0)
    wide = alignment.linked(a, b, *ends)
    assert all((x == y).all() for x, y in zip(plain, wide)) and plain[1].sum() == 4 * 3 + 1


def test_alignment_of_odd_rows(spark, odd_docs, no_docs, clashing):
    align = lambda df: alignment.weighed(alignment.align(df, P.path(TOKENIZER), P.path(PIECES)))
    rows = align(clashing).collect()
    assert len(rows) == odd_docs.count() and align(no_docs).count() == 0
    assert all(r["n_a"] == r["n_links"] == r["count_sum"] == 0 for r in rows if r["doc_id"] in (1, 2))
    assert len({(r["n_links"], r["n_best"], r["count_sum"]) for r in rows if r["doc_id"] in (5, 6)}) == 1
