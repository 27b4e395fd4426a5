"""The corpus operators' queries and their SQL."""

from spindrift.llm import embdedup, linededup, minhash, mixing, packing, repeats, tokenids, topk, toxicity, urlfilter

MODULES = (embdedup, linededup, minhash, mixing, packing, repeats, tokenids, topk, toxicity, urlfilter)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
QUERY_SQL = {k: v for m in MODULES for k, v in m.QUERY_SQL.items()}
