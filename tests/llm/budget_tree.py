"""A plain tree of budgets, filled node by node, that the mixing is held against."""

from dataclasses import dataclass, field


@dataclass
class Node:
    weight: float = 1.0
    tokens: int = 0  # held by the documents below it
    budget: float = 0.0
    children: dict[str, "Node"] = field(default_factory=dict)

    def capacity(self, epochs: int) -> float:
        return self.tokens * epochs


def tree(leaves: list[tuple[tuple[str, ...], int]], weights: dict[tuple[str, ...], float] | None = None) -> Node:
    """The tree over leaf paths and their tokens; ``weights`` maps paths (of any depth) to weights."""
    root = Node()
    for path, tokens in leaves:
        root.tokens += tokens
        node = root
        for depth, name in enumerate(path):
            weight = (weights or {}).get(path[: depth + 1], 1.0)
            node = node.children.setdefault(name, Node(weight))
            node.tokens += tokens
    return root


def share_out(node: Node, budget: float, epochs: int) -> float:
    """Give ``budget`` to a node; children's shortages go to siblings first.  Returns what is left over."""
    node.budget = min(budget, node.capacity(epochs))
    if node.children:
        left = node.budget
        offered = {name: 0.0 for name in node.children}
        open_ = [n for n, c in sorted(node.children.items()) if c.weight > 0 and c.tokens]
        while open_ and left > 1e-9:
            total = sum(node.children[n].weight for n in open_)
            full = []
            given = 0.0
            for n in open_:
                child = node.children[n]
                more = left * child.weight / total
                room = child.capacity(epochs) - offered[n]
                if more >= room:
                    full.append(n)
                    more = room
                offered[n] += more
                given += more
            left -= given
            if not full:
                break
            open_ = [n for n in open_ if n not in full]
        node.budget = sum(offered.values())
        for n, child in node.children.items():
            share_out(child, offered[n], epochs)
    return budget - node.budget


def leaf_budgets(node: Node, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], int]]:
    if not node.children:
        return [(path, int(node.budget + 1e-6))]
    return [x for n, c in sorted(node.children.items()) for x in leaf_budgets(c, (*path, n))]
