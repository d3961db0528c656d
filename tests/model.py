"""The corpus as plain dictionaries, grown one look-up after the other."""

from __future__ import annotations

import json
import random


class Model:
    """Papers by key, edges as a set; insertion order gives the ids."""

    def __init__(self, papers):
        self.papers = {p[1]: list(p) for p in papers}
        self.edges = set()
        self.next_id = max(p[0] for p in papers) + 1

    def add(self, key, title, abstract, url, term, hops):
        if key not in self.papers:
            self.papers[key] = [self.next_id, key, title, abstract, term, hops, url, False]
            self.next_id += 1

    def waiting(self, term, hop):
        rows = [p for p in self.papers.values() if p[4] == term and p[5] == hop and not p[7]]
        return [p[1] for p in sorted(rows)]

    def expand(self, terms, hop, look_up):
        """``look_up(key)`` gives the citing and the cited papers as (key, title, abstract, url)."""
        for term in terms:
            for parent in self.waiting(term, hop):
                citing, cited = look_up(parent)
                for neighbour in citing:
                    self.add(*neighbour, term, hop + 1)
                    self.edges.add((neighbour[0], parent))
                for neighbour in cited:
                    self.add(*neighbour, term, hop + 1)
                    self.edges.add((parent, neighbour[0]))
                self.papers[parent][7] = True

    def rows(self):
        """As tuples in the column order of the papers table."""
        return sorted((tuple(p) for p in self.papers.values()), key=repr)


def random_corpus(seed, papers=40, edges=160, terms=("t0", "t1", "t2", "other")):
    """Seed papers, edges with a hub at one end of a third of them, and titles of all nodes."""
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(papers * 3)]
    hub = nodes[0]
    pairs = set()
    while len(pairs) < edges:
        a, b = rng.choice(nodes), rng.choice(nodes)
        if rng.random() < 1 / 3:
            a, b = (a, hub) if rng.random() < 0.7 else (hub, a)
        pairs.add((a, b))
    ids = rng.sample(range(1, 1000), papers)
    seeds = [
        (ids[i], nodes[i], f"title {i}", "text", rng.choice(terms), 0, None, rng.random() < 0.2)
        for i in range(papers)
    ]
    return seeds, sorted(pairs), {n: (f"about {n}", f"text {n}", f"/{n}") for n in nodes}


def landed(parents, edges, about, per_page=3):
    """Look-ups of the parents, a few neighbours to a page, in the order of the edge list."""
    rows = []
    for number, parent in enumerate(parents):
        for direction, key, mine in ((0, "citingPaper", 1), (1, "citedPaper", 0)):
            found = [edge[1 - mine] for edge in edges if edge[mine] == parent]
            pages = [found[i : i + per_page] for i in range(0, len(found), per_page)] or [[]]
            for page, part in enumerate(pages):
                items = [
                    {key: dict(zip(("paperId", "title", "abstract", "url"), (n, *about[n])))} for n in part
                ]
                body = json.dumps(items if page % 2 else {"data": items})
                rows.append((number, parent, direction, page, 200, body))
    return rows
