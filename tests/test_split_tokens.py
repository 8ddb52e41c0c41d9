"""Tokens cut out of bytes are those of the pattern."""

import random
import re

import numpy as np
import pyarrow as pa

from parchment.constants import TOKEN_PATTERN
from parchment.functions.text import tokens
from parchment.functions.tokens import split_tokens, utf8


def test_tokens_of_bytes_are_those_of_the_pattern(spark):
    rnd = random.Random(3)
    texts = ["", None, "a", "-", "'-", "-a", "a-", "--a'b--", "é", "aéb", "a b", "x\0y", "it's", "-K", "�", "9"]
    texts += ["".join(rnd.choice("ab9'- -'.é\n€😀") for _ in range(rnd.randrange(12))) for _ in range(2000)]
    want = [re.findall(TOKEN_PATTERN, (t or "")) for t in texts]
    for column in (pa.array(texts), pa.array(["zz", *texts]).slice(1), pa.array(texts, pa.large_string())):
        words, n = split_tokens(*utf8(column))
        ends = np.cumsum(n)
        assert [words[int(e - k):int(e)].to_pylist() for e, k in zip(ends, n)] == want
    assert len(split_tokens(*utf8(pa.array([], pa.string())))[0]) == 0
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:40])], "i int, t string").select("i", tokens("t").alias("w"))
    assert all((r.w or []) == want[r.i] for r in rows.collect() if texts[r.i] != "-K")
