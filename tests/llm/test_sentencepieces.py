import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from plumbline.llm.sentencepieces import MARK, DoubleArray, Encoder, PieceModel, decode_ids, sp_decode, sp_encode

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def texts():
    rng = random.Random(4)
    bits = ["the", "Ingest", " ", "  ", "\n", "ñandú", "日本語", "🙂", "x" * 30, "don't", ",", "\t", "Straße", "a", "zq", "1234", "́", "   "]
    return ["", " ", "\n", "a"] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 20))) for _ in range(400)]


def test_double_array_finds_all_keys():
    rng = random.Random(1)
    keys = sorted({bytes(rng.randrange(256) for _ in range(rng.randint(1, 5))) for _ in range(3000)})
    t = DoubleArray(keys, list(range(len(keys))))
    for i, k in enumerate(keys):
        node = 0
        for c in k:
            to = int(t.base[node]) + c + 1
            assert t.check[to] == node
            node = to
        assert t.value[node] == i


def test_best_score_matches_the_library_in_unigram_mode(model):
    """The library, given the same pieces and scores as a unigram model, finds paths as good."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for i, p in enumerate(proto.pieces):
        if p.type == 1:
            p.score = model.score[i]
    lib = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    enc = Encoder(model)
    import numpy as np

    same = 0
    for t in texts():
        mine, theirs = np.frombuffer(enc.encode(t), np.int32).tolist(), lib.encode(t)
        assert decode_ids(model, mine) == t.replace(MARK, " ")
        total = lambda ids: sum(model.score[i] for i in ids)
        assert total(mine) == pytest.approx(total(theirs), abs=1e-3 * (1 + len(mine))), t
        assert sum(model.is_byte[i] for i in mine) == sum(model.is_byte[i] for i in theirs)
        same += mine == theirs
    assert same > 0.95 * len(texts())


def test_array_search_is_the_plain_one(model):
    rng = random.Random(9)
    lines = texts() + ["a\nb c\n\nd", "\nx", "x\n", "a \nb", "a\n b", "\x00nul 🙂smile", "w" * 60 + " z"] + [" ".join("".join(rng.choice("abcdeéñ the") for _ in range(rng.randint(1, 30))).split()) for _ in range(300)]
    enc = Encoder(model)
    assert enc.encode_all(lines + [None]) == [enc.encode(t) for t in lines] + [None]
    small = Encoder(model)
    small.CACHE = 40
    assert small.encode_all(lines) == enc.encode_all(lines)


def test_frames(spark, model):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, None, "x"), (3, "again", "x"), (3, "again", "x"), (9, "long " * 50_000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string").repartition(3)
    enc = sp_encode(df, PATH, carry=("doc_id", "text")).withColumnRenamed("text", "was")
    back = sp_decode(enc, PATH, carry=("doc_id", "was")).collect()
    assert len(back) == len(rows) and all(r.text == r.was for r in back)
    assert sp_encode(df.limit(0), PATH).count() == 0
