"""Pieces of byte-pair files, encoded fast and as the tokenizers library does.

The library is the measure. Its files hold merges in order; where every merge makes a higher id than those before it
and every word of the vocabulary is what its own merges give, merging by lowest id is the same thing, and
tiktoken's core does that several times faster. ``ranks_agree`` proves both for a file; where it doesn't hold, all
pieces go to the library.
"""

from __future__ import annotations

import functools
import json


@functools.cache
def _alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def _file(path: str) -> tuple[dict[str, int], list[tuple[str, str]], str, int]:
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model = made["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return model["vocab"], merges, model.get("end_of_word_suffix") or "", len(made["added_tokens"])


@functools.cache
def ranks_agree(path: str) -> bool:
    """Whether merging by lowest id gives what the file's merges give, for every piece."""
    vocab, merges, suffix, _ = _file(path)
    ids = [vocab.get(a + b, -1) for a, b in merges]
    if min(ids) < 0 or any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return False
    order = {pair: i for i, pair in enumerate(merges)}
    made = {a + b for a, b in merges}
    for word in made:
        cut = word.removesuffix(suffix) if suffix else word
        parts = list(cut)
        if suffix and word.endswith(suffix):
            parts[-1] += suffix
        while len(parts) > 1:
            best = min(zip(parts, parts[1:], strict=False), key=lambda p: order.get(p, 1 << 60))
            if best not in order:
                return False
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
    return True


@functools.cache
def library(path: str):
    """The library's tokenizer, one for each worker process and file."""
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


@functools.cache
def _core(path: str):
    import tiktoken

    vocab, _, suffix, _ = _file(path)
    code = _alphabet()
    ranks = {}
    ends = _ends()
    for word, i in vocab.items():
        last = bool(suffix) and word.endswith(suffix)
        body = word[: -len(suffix)] if last else word
        if not body or any(c not in code for c in body):
            continue
        raw = bytes(code[c] for c in body)
        if suffix:
            inner, end = (raw[:-1], raw[-1]) if last else (raw, None)
            if any(b in ends.values() for b in inner) or last and end not in ends:
                continue  # such bytes stand for word ends here
            raw = inner + bytes([ends[end]]) if last else raw
        ranks[raw] = i
    for b in range(256):
        ranks.setdefault(bytes([b]), 1_000_000 + b)  # never met: words are letters in lower case
    return tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


@functools.cache
def _ends() -> dict[int, int]:
    """For files with word ends: last byte -> the byte that stands for it and the end. Words of lower-case letters have bytes a-z
    and 0x80 up only, so the other ASCII bytes are free."""
    free = [*range(0x00, 0x61), *range(0x7B, 0x80)]
    return dict(zip([*range(0x61, 0x7B), *range(0x80, 0xC0)], free, strict=False))


def piece_encoder(path: str):
    """A function from the bytes of one piece to its ids, for files without word ends."""
    return _core(path)


def word_encoder(path: str):
    """The same for words of lower-case letters, for files with word ends."""
    core, ends = _core(path), _ends()

    def encode(raw: bytes) -> list[int]:
        return core(raw[:-1] + bytes([ends[raw[-1]]]))

    return encode
