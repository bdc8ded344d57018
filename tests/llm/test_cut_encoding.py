"""The encoder of packing and token output: texts cut at white space, against the library."""

import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from vaultgauge.llm import packing, wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return lambda text: found.encode(text, add_special_tokens=False).ids


def ids_of(text):
    return np.frombuffer(packing.encoder(PATH).encode(text), "<u4").tolist()


@pytest.mark.parametrize("seed", range(4))
def test_white_space_of_all_kinds(library, seed):
    r = random.Random(seed)
    letters = " \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 ᠎   　​﻿'stlvem.aé1½٣ß漢́|"
    for _ in range(3000):
        text = "".join(r.choice(letters[: r.randint(1, len(letters))]) for _ in range(r.randint(0, 14)))
        assert ids_of(text) == library(text), text


@pytest.mark.parametrize("text", ["", " ", "a  ", "  a", "a \n b", "<|endoftext|>  a\n\n<|endoftext|> ", " " * 50_000 + "x", "x" + " \n" * 30_000])
def test_runs_of_white_space(library, text):
    assert ids_of(text) == library(text)


@pytest.mark.parametrize("module", [packing, wavelet])
def test_a_text_without_runs_is_encoded_by_one_call(module, monkeypatch):
    known, calls = module.encoder(PATH), []
    encode = known.encode_ordinary
    monkeypatch.setattr(known, "encode_ordinary", lambda text: calls.append(text) or encode(text))
    known.encode(" ".join(f"word{i}" for i in range(5000)))
    assert len(calls) == 1
