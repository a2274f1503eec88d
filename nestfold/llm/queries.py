"""Every query of the subpackage; importing this registers them."""

from nestfold.llm import chat, collocations, decontam, dedup, jaccard, lm, mixing, repeats, search, tokens, toxicity, urls, warc  # noqa: F401
from nestfold.llm.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
