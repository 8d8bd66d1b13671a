import base64

import public_tokenizers
import tiktoken

from skeinwork.llm import tokencounts as T

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_counts_equal_a_walk_over_the_tokens(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [None, "", "one", "\n", "a\n\n\nb\n", "é界\n  indented\r\n\n\nübung 界", "x" * 500 + "\n" + "y", "line\n" * 50]
    docs = spark.createDataFrame([(i or None, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, section string")
    got = {}
    for r in T.count_sections(docs, PATH).collect():
        got.setdefault(r["doc_id"] or 0, []).append(r)
    assert set(got) == {i for i, t in enumerate(texts) if t}
    for i, text in enumerate(texts):
        if not text:
            continue
        own = sorted(got[i], key=lambda r: r["section"])
        lines = text.splitlines(keepends=True) if "\r" not in text else [x + "\n" for x in text.split("\n")[:-1]] + [text.split("\n")[-1]]
        assert [text[r["char_start"] : r["char_end"]] for r in own] == lines
        ids, at, want, cross = library.encode_ordinary(text), 0, [0] * len(lines), [0] * len(lines)
        ends = [len("".join(lines[: k + 1]).encode()) for k in range(len(lines))]
        for token in ids:
            size = len(library.decode_single_token_bytes(token))
            k = next(k for k, e in enumerate(ends) if at < e)
            want[k] += 1
            cross[k] += at + size > ends[k]
            at += size
        assert [r["n_tokens"] for r in own] == want and [r["n_crossing"] for r in own] == cross
        assert sum(want) == len(ids)
    assert T.count_sections(docs.limit(0), PATH).count() == 0


def test_very_long_texts_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a line of words\n" * 40_000), (2, "word " * 100_000), (3, "x y\nz"), (3, "x y\nz"), (None, "x y\nz")], "doc_id long, text string")
    rows = {}
    for r in T.count_sections(docs, PATH).collect():
        rows.setdefault(r["doc_id"], []).append((r["section"], r["n_tokens"]))
    assert len(rows[1]) == 40_000 and len({n for _, n in rows[1]}) == 1 and len(rows[2]) == 1
    assert sorted(rows[3]) == sorted(2 * rows[None])
