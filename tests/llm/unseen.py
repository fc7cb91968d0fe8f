"""How well wording is found that no list holds: ``python tests/llm/unseen.py [folder]`` leaves out one line after the other and asks
whether the others still find it; the share of natural texts that are taken for one is measured on the folder's tables.

Of problem 4 refusals and log phrases are left out; of problem 10 a line of filler or notices (and all lines that it equals)."""

from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from shardloom.llm import pairs, residue  # noqa: E402


def templates(text: str, parts: str) -> tuple[int, int]:
    lines = [line for line in text.strip().splitlines() if line.strip()]
    found = 0
    for i, line in enumerate(lines):
        found += pairs.Templates("\n".join(lines[:i] + lines[i + 1 :]), parts).align(pairs.tokens(line))
    return found, len(lines)


def pages(folder: str) -> dict[str, tuple[int, int]]:
    texts = [t for t in pq.read_table(f"{folder}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    natural = np.zeros(residue.BUCKETS)
    for part in residue._chunks(texts):
        natural += np.bincount(residue._Grams([residue.plain(s) for t in part for s in residue.sentences(t)]).buckets, minlength=residue.BUCKETS)
    out = {}
    for name in ("FILLER", "NOTICES"):
        whole = getattr(residue, name)
        said = [s for s in dict.fromkeys(residue.sentences(whole)) if len(s) >= residue.LEAST]
        found = 0
        for s in said:
            setattr(residue, name, "\n".join(x for x in residue.sentences(whole) if residue.plain(x) != residue.plain(s)))
            found += residue._Grams([residue.plain(s)]).shares(residue.log_ratios(natural))[0] >= residue.SENTENCE
        setattr(residue, name, whole)
        out[name] = (found, len(said))
    return out


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    for name, parts in (("REFUSALS", "DECLINING"), ("REFUSED", "REFUSING"), ("CUT_SHORT", "CUTTING")):
        found, n = templates(getattr(pairs, name), getattr(pairs, parts))
        print(f"{name}: {found} of {n} found when left out")
    for name, (found, n) in pages(folder).items():
        print(f"{name}: {found} of {n} found when left out")
