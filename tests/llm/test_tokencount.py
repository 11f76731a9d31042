import public_tokenizers
import pytest
from llm_helpers import odd_rows, pandas_of, prose

from waveline.llm import tokencount

TEXTS = ["", " ", "  \n\n x", "don't we'll I'd", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "日本語 text ½ ²³ ٣٤", "tabs\t\t and   gaps \n", "e\u0301 \U0001f600 \u200b", "!!??...", "x" * 5000, prose(1, 800)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_as_the_library_counts(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    counter = tokencount.TokenCounter(path)
    assert counter.by_pieces == (name == "byte_bpe_50k.json")
    want = [len(e) for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    assert counter.count(TEXTS) == want and counter.count(TEXTS[::-1]) == want[::-1]


def test_sentence_pieces():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert tokencount.TokenCounter(path).count(TEXTS) == [len(x) for x in library.encode(TEXTS)]


@pytest.mark.parametrize("rows,chars", [(1, 1 << 20), (3, 40), (2000, 1 << 22)])
def test_blocks_of_any_size_count_alike(make_docs, monkeypatch, rows, chars):
    monkeypatch.setattr(tokencount, "BLOCK_ROWS", rows)
    monkeypatch.setattr(tokencount, "BLOCK_CHARS", chars)
    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokencount, "PART_CHARS", chars // 2)
    assert [x for part in tokencount._parts(TEXTS) for x in TEXTS[part]] == TEXTS
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(make_docs(list(enumerate(TEXTS))), path).collect()}
    assert [got[i] for i in range(len(TEXTS))] == tokencount.TokenCounter(path).count(TEXTS)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_query_counts_as_the_library(make_docs, name):
    path = public_tokenizers.path(name)
    texts = [t or "" for _, t, *_ in odd_rows()] + TEXTS + [prose(i, 30) for i in range(40)]
    if name.endswith(".model"):
        import sentencepiece

        want = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    else:
        from tokenizers import Tokenizer

        want = [len(e) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    got = {r.doc_id: (r.n_tokens, r.n_bytes) for r in tokencount.token_counts(make_docs(list(enumerate(texts))), path).collect()}
    assert [got[i] for i in range(len(texts))] == [(n, len(t.encode())) for n, t in zip(want, texts)]


def test_each_pretoken_is_encoded_once_and_joined(make_docs):
    df = tokencount.token_counts(make_docs([(1, "a b"), (2, "b c")]), public_tokenizers.path("byte_bpe_50k.json"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "RepartitionByExpression [piece" in plan and "CartesianProduct" not in plan


def test_table(make_docs):
    rows = odd_rows()
    path = public_tokenizers.path("byte_bpe_50k.json")
    out = pandas_of(tokencount.token_counts(make_docs(rows), path))
    assert len(out) == len(rows)
    assert sorted(out.n_bytes) == sorted(len((t or "").encode()) for _, t, *_ in rows)
    assert (out.over_limit == (out.n_tokens > 512)).all() and out.over_limit.sum() == 2
    assert tokencount.token_counts(make_docs([]), path).collect() == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        tokencount.TokenCounter("x.txt")
