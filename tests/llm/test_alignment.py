"""Token alignment against plain loops over whole texts."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyweave.llm import alignment


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _tokens(sides, text):
    if not text:
        return [], []
    letters = alignment._byte_letters()
    a = [(i, bytes(letters[c] for c in sides[0].id_to_token(i))) for i in sides[0].encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sides[1].encode(text):
        piece = sides[1].id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def _want(sides, rows):
    per, count = [], Counter()
    for doc_id, text in rows:
        ranges = []
        for side in _tokens(sides, text):
            at, own = 0, []
            for i, x in side:
                own.append((at, at + len(x), i))
                at += len(x)
            ranges.append(own)
        a, b = ranges
        links, j = [], 0
        for start, end, i in a:
            while j < len(b) and b[j][1] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][0] < end:
                links.append((i, b[k][2]))
                k += 1
        both = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, at = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for s, e, i in side if at <= s and e <= end) for side in (a, b)) if len(a) < 3000 else None)
            at = end
        count.update(links)
        per.append((doc_id, a, b, both, links, groups))
    top = {}
    for (_, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    return [
        (doc_id, len(a), len(b), len(both), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc_id, a, b, both, links, groups in per
    ]


def _same(found, want):
    assert len(found) == len(want)
    for got, own in zip(sorted(found, key=repr), sorted(want, key=repr), strict=True):
        assert got == own or (own[-1] is None and got[:-1] == own[:-1])


ODD = [None, "", " ", "  two  spaces", "one", "É ü 🙂🙂 中文 字", "a▁b", "x <|endoftext|> y </s> <s> <0x41>", "tab\tand\nline \n\n end ", "z" * 20000, "it's we'll 12345 3.14 (a) [b] \"c\" d%", "ﬁ ① ｆｕｌｌ", "\x00 \x7f", "a b", "é e ́x"]
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("block", [1_500_000, 3000])
def test_alignment_against_loops(spark, sides, monkeypatch, block):
    """With small blocks the long texts go on in further ones."""
    monkeypatch.setattr(alignment, "BLOCK_CHARS", block)
    rng = random.Random(6)
    marks = [*" ab\n▁\t</é🙂　", "the", "  ", " word", "'s", ", ", ". ", "_", "-", "123"]
    rows = [(r.doc_id, r.text[:6000]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()[:80]]
    rows += [(500 + i, t) for i, t in enumerate(ODD)] + [(7, rows[7][1]), (None, rows[3][1])]
    rows += [(1000 + i, "".join(rng.choice(marks) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_a int").repartition(3)
    # the block's size is read in the workers, so it is sent along with the function
    monkeypatch.setattr(alignment, "_blocks", _with_block(block))
    _same([tuple(r) for r in alignment.align(docs).select(*COLUMNS).collect()], _want(sides, rows))


def _with_block(chars, made=alignment._blocks):
    def blocks(side_a, side_b):
        def over(batches):
            alignment.BLOCK_CHARS = chars
            yield from made(side_a, side_b)(batches)

        return over

    return blocks


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(docs).select(*COLUMNS).collect()), key=repr) == sorted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=repr)
    assert alignment.align(docs.limit(0)).collect() == []


def test_parts_are_encoded_as_the_whole(sides):
    rng = random.Random(8)
    tools = alignment.encoders()
    marks = [*" ab,.;\n\t(['\"%)]▁é🙂中　 ​́_", "the", "  ", " 's", " word", "12", " 3"]
    for _ in range(3000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(1, 25)))
        parts = alignment._CUT.split(text)
        slot = tools.slots(parts)
        for side, want in ((0, sides[0].encode(" " + text, add_special_tokens=False).ids), (1, sides[1].encode(text))):
            assert [x for k in slot for x in tools.ids[side][tools.begins[side][k] : tools.begins[side][k + 1]]] == want
        assert tools.sound[slot].all() == bool(_tokens(sides, text)[0])
    whole = " ".join(f"{''.join(rng.choice(marks) for _ in range(4))}" for _ in range(5000))
    parts = alignment._CUT.split(whole)
    tools.forget()
    slot = tools.slots(parts)
    assert [x for k in slot for x in tools.ids[1][tools.begins[1][k] : tools.begins[1][k + 1]]] == sides[1].encode(whole)
