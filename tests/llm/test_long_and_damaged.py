"""Very long runs and tokens, other scripts' digits, and mentions that only the skip edges find."""

import dataclasses
import time

import numpy as np
import pytest
import public_tokenizers
from conftest import SF_SMALL  # tests/conftest.py
from tokenizers import Tokenizer

from adfeat.llm import pii
from adfeat.llm.packing import LONG_RUN, _encoder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "\n" * 2_000_000, "a" * 2_000_000, "-" * LONG_RUN, "word " * 300_000], ids=["blanks", "lines", "letters", "dashes", "words"])
def test_runs_of_any_length_are_encoded_as_the_library_does(text):
    assert _encoder(BYTE_BPE)(text) == Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids


def test_digits_of_other_scripts_and_long_numbers():
    field = pii.fit(["call +1 555 234 5678 or 10.1.2.3", "x 12 y"])
    found = lambda t: [(pii.KINDS[k], t[s:e]) for s, k, e in pii.all_spans([t], field)[0][0]]
    assert found("1.2.3.² and 10.²³.1.2 and ٣.1.2.3.4x") == [("ip", "1.2.3.4")]
    zeros = "0" * 5000
    assert found(f"{zeros}.1.2.3") == [("ip", f"{zeros}.1.2.3")] and found(f"{zeros}1.256.2.3") == []


def test_many_and_long_tokens():
    field = pii.fit(["mail a@b.com or 10.1.2.3", "x 12 y"])
    many = " ".join(f"a{i}@b{i}.com" for i in range(16_000))
    began = time.perf_counter()
    base, every = pii.all_spans([many], field)[0]
    assert len(base) == 16_000 and time.perf_counter() - began < 10
    long = "x" * 2500 + "@" + "y" * 2500 + ".com"
    assert len(pii.all_spans([long], field)[0][0]) == 1 and pii.graph([long]).start.tolist() == [0]
    minified = '{"a":"10.1.2.3","b":"q@r.com","c":12,' + '"pad":"' + "z" * 300 + '"}'
    g = pii.graph([minified])
    assert [minified[s:e] for s, e in zip(g.start, g.end, strict=True)] == ["10.1.2.3", "q@r.com", "12"]


class _NoSkip(pii.Field):
    def marginals(self, g):
        return pii.Field.marginals(self, dataclasses.replace(g, skip=np.zeros((0, 2), np.int64)))


def test_skip_edges_find_damaged_repeats(spark):
    """A mention that no rule takes, of an address that a rule found elsewhere in the text."""
    docs = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if r.text and pii._EVIDENCE(r.text)]
    extra = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text and pii._EVIDENCE(r.text)]
    field = pii.fit([t for t in docs + extra if len(t) < pii.SAMPLE_CHARS])
    without = _NoSkip(field.unary, field.chain, field.skip)
    texts, wanted = [], []
    for i in range(60):
        whole, damaged = (f"mira{i}@corvu{i}.com", f"mira{i}@corvu{i}") if i % 2 else (f"10.{i + 20}.7.{i + 130}", f"10-{i + 20}-7-{i + 130}")
        text = f"They wrote to {whole} and the day after that to {damaged} but had no answer"
        texts.append(text)
        wanted.append((text.index(damaged + " but"), i % 2 == 0, len(damaged)))
    hits = {}
    for name, f in (("with", field), ("without", without)):
        hits[name] = sum((s, int(ip), s + n) in set(every) - set(base) for (s, ip, n), (base, every) in zip(wanted, pii.all_spans(texts, f), strict=True))
    assert hits["with"] >= 50 and hits["without"] <= 5, hits


def test_neighbours_of_one_kind_are_one_added_span():
    g_text = "a 555 7672 b"

    class Sure(pii.Field):
        def marginals(self, g):
            p = np.zeros((len(g.start), pii.NONE + 1))
            p[:, 3] = 1
            return p

    k = pii.NONE + 1
    assert pii.all_spans([g_text], Sure(np.zeros((pii.N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k))))[0][1] == [(2, 3, 10)]
