"""Token counts of texts with long white space."""
import pytest

from sevscope.llm import bpe as B
from sevscope.llm.lengths import token_counts


@pytest.mark.parametrize("blank", [" ", "\n", "\t", " ", "　", " \n"])
def test_long_runs_are_the_pieces_of_the_pattern(blank, monkeypatch):
    """With runs cut from 3 characters on, counts are those of the encoder on the whole text."""
    enc = B.Bpe().encoder()
    monkeypatch.setattr(B, "_RUN", B.re.compile(B._RUN.pattern.replace(f"{{{B.LONG},}}", "{3,}")))
    for n in (1, 2, 3, 4, 7, 50, 300):
        w = blank * n
        for text in (w, f"{w}word", f"word{w}", f"a{w}b{w}1{w}", f"x{w}'s{w}!?{w} end", f"{w}\x1c{w}é"):
            assert B.count_tokens(enc, text) == len(enc.encode_ordinary(text)), (n, text[:20])


def test_very_long_white_space(spark):
    n = 1_000_000
    texts = [w for b in (" ", "\n", "\t") for w in (b * n, f"{b * n}a", f"word{b * n}", f"one{b * n}two")]
    df = spark.createDataFrame(list(enumerate(texts)) + [(99, None), (98, "")], "doc_id long, text string")
    got = dict(map(tuple, token_counts(df, B.Bpe()).collect()))
    enc = B.Bpe().encoder()
    piece = {b: len(enc._encode_single_piece(b * n)) for b in (" ", "\n", "\t")}
    less = {b: len(enc._encode_single_piece(b * (n - 1))) for b in (" ", "\n", "\t")}
    rest = lambda t: len(enc.encode_ordinary(t))
    want = [c for b in (" ", "\n", "\t") for c in (piece[b], less[b] + rest(b + "a"), rest("word") + piece[b], rest("one") + less[b] + rest(b + "two"))]
    assert [got[i] for i in range(len(texts))] == want and got[99] == got[98] == 0
