"""Deeply nested records into flat tables, linked by interval labels.

The dimensions of a context are a tree written as JSON. A depth-first walk gives each node a
pre-order and a post-order number; node p is an ancestor of node n exactly when
p.pre < n.pre and p.post > n.post, so a node's parent is the innermost open interval around it.
One pass over the labels in pre-order with a stack of open intervals finds it in linear time.

Defined results: null, blank, broken JSON, scalars, `{}` and `[]` hold no node. A single node may
stand where a list is expected. An object without `axis` names one node per key, in key order; a
key whose value is null gives a node without member. Entries of a list that are no objects are
no nodes, and take no place among their siblings. Facts without a context (null or empty) keep
their row in the fact table with a null context key, and add no context. Rows that come twice
count once. The nodes of a context are the union over all distinct texts of `dims` that name it,
as one tree with one set of labels.
Other columns of the input are ignored, whatever they are called.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "doc_id string, context_ref string, node_path string, axis string, pre int, post int, depth int, "
    "parent_pre int, parent_path string, member string, typed string, node_order string, labels array<struct<lang:string,text:string>>"
)


class _Pairs(list):
    """An object as the list of its (key, value) pairs: keeps the order, and keys that come twice."""


def _as_nodes(x) -> list[dict]:
    """The nodes that stand at one place: a list, a single node, or a plain object."""
    if isinstance(x, _Pairs):
        keys = [k for k, _ in x]
        if "axis" in keys:
            return [dict(x)]
        return [{"axis": k, "member": v} for k, v in x]
    if isinstance(x, list):
        return [n for item in x if isinstance(item, _Pairs) for n in _as_nodes(item)]
    return []


class _Sign(str):
    """A piece of JSON between values."""


def _text(x) -> str | None:
    """A string as it is, anything else as JSON without blanks, with its own stack."""
    if x is None or isinstance(x, str):
        return x
    out, left = [], [x]
    while left:
        v = left.pop()
        if isinstance(v, _Sign):
            out.append(v)
        elif isinstance(v, list):
            ends, parts = ("{}", [[_Sign(f"{json.dumps(k, ensure_ascii=False)}:"), w] for k, w in dict(v).items()]) if isinstance(v, _Pairs) else ("[]", [[w] for w in v])
            row = [_Sign(ends[0])]
            for i, part in enumerate(parts):
                row += [_Sign(","), *part] if i else part
            left += reversed([*row, _Sign(ends[1])])
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


BLANK = re.compile(r"[ \t\n\r]*")


def _read(text: str):
    """json.loads(text, object_pairs_hook=_Pairs) with its own stack, for texts too deep for that."""
    scalar = json.JSONDecoder().raw_decode
    holders: list[list] = []
    keys: list[str | None] = []

    def after(i: int) -> int:
        return BLANK.match(text, i).end()

    def key(i: int) -> tuple[str, int]:
        i = after(i)
        if text[i : i + 1] != '"':
            raise ValueError(f"no key at {i}")
        k, i = scalar(text, i)
        i = after(i)
        if text[i : i + 1] != ":":
            raise ValueError(f"no colon at {i}")
        return k, i + 1

    i = 0
    while True:
        i = after(i)
        c = text[i : i + 1]
        if c == "{" or c == "[":
            value = _Pairs() if c == "{" else []
            i = after(i + 1)
            if text[i : i + 1] != ("}" if c == "{" else "]"):
                k, i = key(i) if c == "{" else (None, i)
                holders.append(value)
                keys.append(k)
                continue
            i += 1
        else:
            value, i = scalar(text, i)
        while True:
            i = after(i)
            if not holders:
                if i < len(text):
                    raise ValueError(f"more at {i}")
                return value
            top = holders[-1]
            named = isinstance(top, _Pairs)
            top.append((keys[-1], value) if named else value)
            c = text[i : i + 1]
            if c == ",":
                i += 1
                if named:
                    keys[-1], i = key(i)
                break
            if c != ("}" if named else "]"):
                raise ValueError(f"not closed at {i}")
            i += 1
            value = holders.pop()
            keys.pop()


def _member(x) -> tuple[str | None, list[dict]]:
    if not isinstance(x, _Pairs):
        return _text(x), []
    d = dict(x)
    found = d.get("labels")
    found = [found] if isinstance(found, _Pairs) else found if isinstance(found, list) else []
    labels = [dict(v) for v in found if isinstance(v, _Pairs)]
    return (
        _text(d.get("qname")) if "qname" in d else _text(x),
        [{"lang": _text(v.get("lang")), "text": _text(v.get("text"))} for v in labels],
    )


def label_tree(dims: str | None) -> list[dict]:
    """The nodes of one `dims` text in pre-order, each with its interval. Iterative, so any depth is read."""
    if not dims or not dims.strip():
        return []
    try:
        try:
            root = json.loads(dims, object_pairs_hook=_Pairs)
        except RecursionError:
            root = _read(dims)
    except ValueError:
        return []
    out: list[dict] = []
    pre = post = 0
    stack = [(iter(enumerate(_as_nodes(root), 1)), "", None)]
    while stack:
        siblings, prefix, owner = stack[-1]
        step = next(siblings, None)
        if step is None:
            stack.pop()
            if owner is not None:
                post += 1
                owner["post"] = post
            continue
        place, node = step
        pre += 1
        member, labels = _member(node.get("member"))
        row = {
            "node_path": f"{prefix}{place}", "axis": _text(node.get("axis")), "pre": pre, "post": 0, "depth": len(stack),
            "member": member, "typed": _text(node.get("typed")), "node_order": _text(node.get("order")), "labels": labels,
        }
        out.append(row)
        stack.append((iter(enumerate(_as_nodes(node.get("children")), 1)), f"{row['node_path']}.", row))
    link_by_containment(out)
    return out


def link_by_containment(nodes: list[dict]) -> None:
    """Sets parent_pre and parent_path of nodes in pre-order from their intervals alone."""
    holding: list[dict] = []
    for n in nodes:
        while holding and holding[-1]["post"] < n["post"]:
            holding.pop()
        n["parent_pre"] = holding[-1]["pre"] if holding else None
        n["parent_path"] = holding[-1]["node_path"] if holding else None
        holding.append(n)


def merged_tree(texts: Iterable[str | None]) -> list[dict]:
    """The nodes of one context in pre-order: the trees of its texts laid over each other, labelled once.

    Nodes are one where their places, contents and ancestors agree; two contents at one place stand
    side by side, each with its own children. Labels are the distinct ones of all texts.
    """
    trees = [t for t in map(label_tree, dict.fromkeys(texts)) if t]
    if len(trees) < 2:
        return trees[0] if trees else []
    top: dict = {}
    for nodes in trees:
        under: dict = {None: top}
        for n in nodes:
            key = (int(n["node_path"].rpartition(".")[2]), *(n[c] or "" for c in CONTENT), *(n[c] is None for c in CONTENT))
            row, kids = under[n["parent_pre"]].setdefault(key, (n, {}))
            if row is not n:
                row["labels"] = row["labels"] + [x for x in n["labels"] if x not in row["labels"]]
            under[n["pre"]] = kids
    out: list[dict] = []
    post = 0
    stack = [(iter(sorted(top.items(), key=lambda kv: kv[0])), None)]
    while stack:
        step = next(stack[-1][0], None)
        if step is None:
            owner = stack.pop()[1]
            if owner is not None:
                post += 1
                owner["post"] = post
            continue
        _, (row, kids) = step
        out.append(row)
        row["pre"] = len(out)
        stack.append((iter(sorted(kids.items(), key=lambda kv: kv[0])), row))
    link_by_containment(out)
    return out


CONTENT = ("axis", "member", "typed", "node_order")


def _expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
    for b in batches:
        rows = [
            (d, c, n["node_path"], n["axis"], n["pre"], n["post"], n["depth"], n["parent_pre"], n["parent_path"], n["member"], n["typed"], n["node_order"], n["labels"])
            for d, c, t in zip(b["doc_id"], b["context_ref"], b["texts"], strict=True)
            for n in merged_tree(t)
        ]
        out = pd.DataFrame(rows, columns=columns)
        out["parent_pre"] = out["parent_pre"].astype("Int32")
        yield out


def _named(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("context_ref").isNotNull() & (F.col("context_ref") != ""))


def _texts(facts: DataFrame) -> DataFrame:
    """doc_id, context_ref, texts: the distinct texts of `dims` of each context.

    Repeated texts fall together before the one shuffle (partial aggregation), so a context with a
    third of all facts costs no more than its distinct texts, which are its tree.
    """
    said = _named(facts).where(F.col("dims").isNotNull() & ~F.trim("dims").isin("", "[]", "{}", "null"))
    return said.groupBy("doc_id", "context_ref").agg(F.array_sort(F.collect_set("dims")).alias("texts"))


def dimension_nodes(facts: DataFrame) -> DataFrame:
    """One row per node of each context: its interval, its parent's, its path, axis, member and labels."""
    return _texts(facts).mapInPandas(_expand, NODE_SCHEMA)


def node_places(facts: DataFrame) -> DataFrame:
    """doc_id, context_ref, node_path, axis: the distinct places of each context's nodes, each context being whole where it is labelled."""
    columns = ["doc_id", "context_ref", "node_path", "axis"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _expand(batches):
            yield b[columns].drop_duplicates()

    return _texts(facts).mapInPandas(run, "doc_id string, context_ref string, node_path string, axis string")


def label_table(facts: DataFrame) -> DataFrame:
    """Labels of members, each pointing to its node."""
    return (
        dimension_nodes(facts)
        .select("doc_id", "context_ref", "node_path", "pre", "member", F.explode(F.array_distinct("labels")).alias("l"))
        .select("doc_id", "context_ref", "node_path", "pre", "member", F.col("l.lang").alias("lang"), F.col("l.text").alias("label"))
    )


def context_table(facts: DataFrame) -> DataFrame:
    """One row per context of a filing, with its period (the latest stated) and its number of facts."""
    return (
        _named(facts)
        .groupBy("doc_id", "context_ref")
        .agg(
            F.max("ctx_instant").alias("ctx_instant"),
            F.max("ctx_end").alias("ctx_end"),
            F.max("scope").alias("scope"),
            F.countDistinct("fact_id").alias("n_facts"),
        )
    )


def fact_table(facts: DataFrame) -> DataFrame:
    """One row per fact, pointing to its context by (doc_id, context_ref)."""
    return facts.select(
        "fact_id", "doc_id", F.when(F.col("context_ref") != "", F.col("context_ref")).alias("context_ref"), "kind", "concept", "unit_ref", "value", "scale", "text"
    ).dropDuplicates(["fact_id"])
