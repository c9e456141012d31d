"""Byte-level BPE encoders from rank files."""

from __future__ import annotations

import base64
import json

import tiktoken


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokens(path: str) -> list[bytes]:
    """The bytes of each id."""
    known = ranks(path)
    out = [b""] * (max(known.values()) + 1)
    for token, rank in known.items():
        out[rank] = token
    return out


def added_tokens(path: str) -> dict[str, int]:
    """The tokens that a tokenizer's JSON file adds to its vocabulary, which are found in texts before anything else."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(token[flag] for token in found for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that look at what is around them are not supported")
    return {token["content"]: token["id"] for token in found}


def encoding(path: str, pattern: str, added: dict[str, int] | None = None) -> tiktoken.Encoding:
    """The encoder of a rank file. Names of tokens that are not ``added`` are ordinary text."""
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens=added or {})


def encode(own: tiktoken.Encoding, text: str | None) -> list[int]:
    """The ids of a text; added tokens in it are their own ids."""
    if text and any(name in text for name in own.special_tokens_set):
        return own.encode(text, allowed_special="all")
    return own.encode_ordinary(text or "")
