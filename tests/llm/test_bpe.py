import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import ODD, SCHEMA, documents, edited, prose
from valuemill.llm import bpe, token_counts
from valuemill.llm.common import rolling_cuts, utf8_block
from valuemill.llm.queries import tokenizer_path

TEXTS = [*ODD, "<|endoftext|>x<|startoftext|> a", "it's we'll I'M they'd", "é ́a", "٣ ½ ²", "\t\n\r\x0b\x0c", "ΑΣ ΑΣΑ ß"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), np.asarray(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_equal_to_the_library(spark, library):
    body = prose(1, 4000)
    texts = TEXTS + [body, edited(body, 2, 0.01), "start " + body, body + " é́nd", prose(3, 900)]
    rows = {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode(documents(spark, texts), tokenizer_path()).collect()}
    assert rows == {i: expected(library, t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("bits", [2, 5, 8])
def test_small_chunks_reuse_and_repair(library, bits):
    import pyarrow as pa

    encoder, body = bpe.ChunkEncoder(tokenizer_path()), prose(5, 1500)
    texts = [t or "" for t in TEXTS] + [body, body, edited(body, 6, 0.02)]
    data, offsets = utf8_block(pa.array(texts))
    found = encoder.encode(data.tobytes(), rolling_cuts(data, offsets, bits), offsets[1:].tolist())
    assert [(len(i) // 4, i, d.decode()) for i, d in found] == [expected(library, t) for t in texts]
    assert encoder.reused > 0 and encoder.repaired > 0 and encoder.whole == 0


def test_a_join_that_disagrees_falls_back_to_the_whole_text(library, monkeypatch):
    import pyarrow as pa

    encoder = bpe.ChunkEncoder(tokenizer_path())
    monkeypatch.setattr(encoder.words, "agrees", lambda window, known: False)
    data, offsets = utf8_block(pa.array([prose(8, 300)]))
    found = encoder.encode(data.tobytes(), rolling_cuts(data, offsets, 4), offsets[1:].tolist())
    assert encoder.whole == 1 and (len(found[0][0]) // 4, found[0][0], found[0][1].decode()) == expected(library, prose(8, 300))


def test_round_trip_of_decode(spark, library):
    ids = bpe.encode(documents(spark, TEXTS), tokenizer_path())
    back = {r.doc_id: r.text for r in bpe.decode(ids, tokenizer_path()).collect()}
    assert back == {i: expected(library, t)[2] for i, t in enumerate(TEXTS)}


def test_null_and_repeated_ids_empty_table(spark, library):
    rows = [(None, "a b", None, None, 1), (1, "a b", None, None, 1), (1, "a b", None, None, 1)]
    got = bpe.encode(spark.createDataFrame(rows, SCHEMA), tokenizer_path()).collect()
    assert [(r.n_tokens, bytes(r.ids)) for r in got] == [expected(library, "a b")[:2]] * 3
    assert bpe.encode(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []


def test_length_report_against_brute_force(spark, library):
    texts = TEXTS + [prose(i, 5 + 7 * i) for i in range(25)] + ["a b"] * 5
    df = documents(spark, texts, [(99, "a", None, None, 1)])
    own = [(s, expected(library, t)[0]) for t, s in [(r.text, r.source) for r in df.collect()]]
    rows = token_counts.length_report(df, tokenizer_path(), by="source").collect()
    assert {(r.scope, r.grp) for r in rows} == {("all", None)} | {("by", s) for s, _ in own}
    for r in rows:
        part, limit = [n for s, n in own if r.scope == "all" or s == r.grp], r.context_limit
        assert (r.n_docs, r.total_docs, r.total_tokens) == (part.count(limit), len(part), sum(part))
        assert (r.docs_over, r.tokens_over, r.tokens_below) == (sum(n > limit for n in part), sum(n for n in part if n > limit), sum(n for n in part if n < limit))
        assert r.truncated_tokens == sum(min(n, limit) for n in part)
        assert r.quantile == pytest.approx(sum(n <= limit for n in part) / len(part))


def test_quantiles_and_empty(spark, library):
    hist = token_counts.histogram(token_counts.encoded_lengths(documents(spark, ["a", "a b", "a b c", "a b c d"]), tokenizer_path(), None))
    assert {r.share: r.length for r in token_counts.quantiles(hist, (0.25, 0.5, 0.51, 1.0)).collect()} == {0.25: 1, 0.5: 2, 0.51: 3, 1.0: 4}
    assert token_counts.length_report(spark.createDataFrame([], SCHEMA), tokenizer_path()).collect() == []


def test_windows_grow_until_their_outer_words_agree(library, monkeypatch):
    import pyarrow as pa

    for refused in range(1, 6):
        encoder = bpe.ChunkEncoder(tokenizer_path())
        seen, agrees = {}, encoder.words.agrees

        def stubborn(window, known, seen=seen, refused=refused, agrees=agrees):  # each comparison fails until it was made `refused` times
            seen[known] = seen.get(known, 0) + 1
            return seen[known] > refused and agrees(window, known)

        monkeypatch.setattr(encoder.words, "agrees", stubborn)
        text = "  " + prose(8, 400, 5000) + " é ́a \t"
        data, offsets = utf8_block(pa.array([text, "short one", text]))
        found = encoder.encode(data.tobytes(), rolling_cuts(data, offsets, 7), offsets[1:].tolist())
        assert [(len(i) // 4, i, d.decode()) for i, d in found] == [expected(library, t) for t in (text, "short one", text)]
        assert encoder.widened > 0


def test_a_tokenizer_that_joins_across_white_space_gets_whole_texts(spark):
    import public_tokenizers

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    own = Tokenizer.from_file(path)
    texts = [*TEXTS, prose(4, 800)]
    rows = {r.doc_id: (r.n_tokens, bytes(r.ids), r.decoded) for r in bpe.encode(documents(spark, texts), path).collect()}
    assert rows == {i: expected(own, t) for i, t in enumerate(texts)}
    lengths = token_counts.encoded_lengths(documents(spark, texts), path, None).collect()
    assert sorted(r.length for r in lengths) == sorted(expected(own, t)[0] for t in texts)


def test_caches_are_bounded_in_bytes_and_long_words_not_kept(library):
    encoder = bpe.ChunkEncoder(tokenizer_path())
    encoder.words.words.most = encoder.chunks.most = 20_000
    import pyarrow as pa
    for i in range(30):
        texts = [prose(i, 300, 100_000), "x" * 5000 + f" {i}"]
        data, offsets = utf8_block(pa.array(texts))
        found = encoder.encode(data.tobytes(), rolling_cuts(data, offsets, 8), offsets[1:].tolist())
        assert [i for i, _ in found] == [expected(library, t)[1] for t in texts]
        held = encoder.words.words
        assert sum(len(w) + len(v) + 250 for g in (held.young, held.old) for w, v in g.items()) <= 2 * 20_000 + 1000
        assert max(len(w) for w in held.young) <= bpe.WORD_KEPT


def test_a_word_of_megabytes(library):
    import pyarrow as pa

    text = "start " + "abcdefghij" * 150_000 + " end"
    encoder = bpe.ChunkEncoder(tokenizer_path())
    data, offsets = utf8_block(pa.array([text]))
    found = encoder.encode(data.tobytes(), rolling_cuts(data, offsets, 10), offsets[1:].tolist())
    assert found[0][0] == expected(library, text)[1]
