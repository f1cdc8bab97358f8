import random
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_files

from stratamart.llm.pieces import Normalizer, Pieces, encode_pieces

from .conftest import EDGES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = [*" \n\t▁aeéü漢字<s>AB09.,'", "\U0001f600", "\x00", "​", "  ", "the", "ing", "0x0A"]

MAPPED = "  ﬁＡ①x ½㌔é́e　\xa0\tカ゛ｶﾞß▁​\n"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def draws(letters, n, most, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(letters, k=pick.randrange(most))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as file:
        return Pieces(file.read())


def test_ids_and_spans_equal_the_library(library, pieces):
    texts = draws(LETTERS, 1500, 30, 1) + ["", " ", "▁▁▁", "a" * 3000, " " * 700, "漢" * 200, "ab" * 40 + "\n" * 90]
    for text, (ids, starts, ends) in zip(texts, pieces.encode(texts), strict=True):
        expected = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in expected], text
        assert [*zip(starts.tolist(), ends.tolist(), strict=True)] == [(p.begin, p.end) for p in expected], text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_spans_under_a_character_map(library, rule):
    """The vocabulary behind another normaliser: the library's own spans are the expected ones."""
    proto = model_files.ModelProto.FromString(library.serialized_model_proto())
    spec = model_files.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()).normalizer_spec
    for squeeze in (False, True):
        proto.normalizer_spec.CopyFrom(spec)
        proto.normalizer_spec.add_dummy_prefix = proto.normalizer_spec.escape_whitespaces = True
        proto.normalizer_spec.remove_extra_whitespaces = squeeze
        file = proto.SerializeToString()
        theirs = sentencepiece.SentencePieceProcessor(model_proto=file)
        texts = draws([*MAPPED, "the ", "ing"], 500, 14, 9)
        for text, (ids, starts, ends) in zip(texts, Pieces(file).encode(texts), strict=True):
            expected = theirs.encode(text, return_type="proto").pieces
            assert [*zip(ids.tolist(), starts.tolist(), ends.tolist(), strict=True)] == [(p.id, p.begin, p.end) for p in expected], text


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("flags", range(8))
def test_normaliser_equals_the_library(rule, flags):
    set_flags = dict(zip(("add_dummy_prefix", "escape_whitespaces", "remove_extra_whitespaces"), (bool(flags & 1 << k) for k in range(3))))
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, **set_flags)
    mine = Normalizer(model_files.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec)
    for text in draws(MAPPED, 400, 14, 3):
        expected, offsets = theirs.normalize(text, with_offsets=True)
        got, sources = mine.normalise(text)
        assert got.decode() == expected
        at = [0, *accumulate(len(c.encode()) for c in expected)]
        source = [0, *accumulate(len(c.encode()) for c in text)]
        assert [sources[k] for k in at] == [source[k] for k in offsets], text


def test_rows_and_round_trip(spark, documents, library):
    rows = [(100 + k, t) for k, t in enumerate(draws(LETTERS, 60, 40, 5))] + EDGES
    got = encode_pieces(documents(rows), PATH).collect()
    assert sorted(repr(r["doc_id"]) for r in got) == sorted(repr(d) for d, _ in rows)
    expected = sorted((library.encode(t or ""), library.decode(library.encode(t or ""))) for _, t in rows)
    assert sorted((r["ids"], r["decoded"]) for r in got) == expected
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in got)
    # Spans of consecutive pieces cover the text.
    by_id = {d: t for d, t in rows if d is not None and d >= 100}
    for r in got:
        if r["doc_id"] in by_id and r["ids"]:
            data, spans = by_id[r["doc_id"]].encode(), [*zip(r["starts"], r["ends"], strict=True)]
            assert b"".join(data[a:b] for a, b in spans) == data
    assert encode_pieces(documents(EDGES).limit(0), PATH).count() == 0


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        proto = model_files.ModelProto.FromString(file.read())
    proto.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        Pieces(proto.SerializeToString())
