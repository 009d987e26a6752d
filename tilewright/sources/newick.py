"""Newick trees, small by nature, read and written on the driver."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

NODES = "node_id string, parent_id string, is_leaf boolean"


def parse(text: str) -> list[tuple[str, str | None, bool]]:
    """(node_id, parent_id, is_leaf) from the root down; unnamed inner nodes become N0, N1, ... in the order in which they open. Branch lengths and comments are dropped."""
    text = re.sub(r"\[[^\]]*\]", "", text.strip()).rstrip(";")
    names: list[str] = []
    parents: list[int | None] = []
    leaf: list[bool] = []
    stack: list[int] = []
    last: int | None = None
    for token in re.findall(r"'(?:[^']|'')*'|[(),]|[^(),']+", text):
        if token == "(":
            names.append("")
            parents.append(stack[-1] if stack else None)
            leaf.append(False)
            stack.append(len(names) - 1)
            last = None
        elif token == ",":
            last = None
        elif token == ")":
            last = stack.pop()
        elif label := token.strip():
            name = label[1:-1].replace("''", "'") if label[0] == "'" else label.split(":")[0].strip()
            if last is not None:
                names[last] = names[last] or name
            elif name:
                names.append(name)
                parents.append(stack[-1] if stack else None)
                leaf.append(True)
                last = len(names) - 1
    if stack:
        raise ValueError("unbalanced parentheses")
    unnamed = iter(f"N{i}" for i in range(len(names)))
    names = [n or next(unnamed) for n in names]
    if len(set(names)) < len(names):
        raise ValueError("node names must differ")
    return [(n, None if p is None else names[p], is_leaf) for n, p, is_leaf in zip(names, parents, leaf)]


def read_newick(spark: SparkSession, path: str) -> DataFrame:
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return spark.createDataFrame(parse(text), NODES)


def format_newick(nodes: list[tuple[str, str | None, bool]]) -> str:
    """Children in order of their names; inner labels kept."""
    children: dict[str | None, list[str]] = {}
    for node, parent, _ in nodes:
        children.setdefault(parent, []).append(node)

    def label(node: str) -> str:
        return f"'{node.replace(chr(39), chr(39) * 2)}'" if re.search(r"[(),:;'\s\[\]]", node) else node

    out: list[str] = []
    open_: list[tuple[str | None, list[str]]] = [(None, sorted(children[None], reverse=True))]  # no recursion: trees may be deep
    while open_:
        node, rest = open_[-1]
        if rest:
            child = rest.pop()
            if out and out[-1] != "(":
                out.append(",")
            if child in children:
                out.append("(")
                open_.append((child, sorted(children[child], reverse=True)))
            else:
                out.append(label(child))
            continue
        open_.pop()
        if node is not None:
            out += [")", label(node)]
    return "".join(out) + ";"


def write_newick(nodes: DataFrame, path: str) -> None:
    """nodes(node_id, parent_id, is_leaf) as one line; a tree over taxa meets on the driver, as it does when it is read."""
    text = format_newick([(r.node_id, r.parent_id, r.is_leaf) for r in nodes.collect()])
    nodes.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
