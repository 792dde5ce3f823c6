"""Small fixtures and a plain-Python re-computation of the tree rules."""

from __future__ import annotations

PYTHON = '''\
import os
from pathlib import Path

class Shop:
    def price(self, item):
        if item:
            return item.cost
        return 0

async def main():
    return Shop()
'''
JAVASCRIPT = '''\
import tools from "./tools";
export class Cart {
  total() { return 0; }
}
const twice = (x) => x * 2;
function outer() {
  function inner() {}
}
'''
TYPESCRIPT = '''\
interface Item { cost: number; }
type Id = string | number;
enum Size { S, M }
export abstract class Box {}
'''
GO = '''\
package main

import "fmt"

type Cart struct { n int }
type Buyer interface { Buy() }
func (c *Cart) Add(n int) { c.n += n }
func main() { fmt.Println("hi") }
'''
CPP = '''\
namespace shop {
class Cart {
public:
  int total() const {
    if (n > 0) { return n; }
    return 0;
  }
};
}
'''
CODE = [
    (1, "a.py", PYTHON, "python"),
    (2, "b.js", JAVASCRIPT, "javascript"),
    (3, "c.ts", TYPESCRIPT, "typescript"),
    (4, "d.go", GO, "go"),
    (5, "e.cpp", CPP, "cpp"),
    (6, "f.txt", "class Nothing:", "text"),
]

# Paths and the languages they stand for.
PATHS = [
    ("test.py", "python"), ("test.js", "javascript"), ("test.jsx", "javascript"),
    ("test.ts", "typescript"), ("test.tsx", "typescript"), ("test.go", "go"),
    ("test.cpp", "cpp"), ("test.cc", "cpp"), ("test.h", "c"), ("test.hpp", "cpp"),
    ("test.unknown", None), ("test.min.js", "javascript"), ("archive.tar.gz", None),
    ("TEST.PY", "python"), ("Makefile", None), (".eslintrc.js", "javascript"),
    (".gitignore", None), ("/path/to/file.py", "python"), ("../relative/path.go", "go"),
    ("C:\\Users\\test\\file.py", "python"), ("/path with spaces/file.js", "javascript"),
    ("file@2.0.ts", "typescript"), ("", None), ("dir.py/file", None), ("dir/.py", None),
    ("a.py/", "python"),
]

MARKUP = [
    (1, "<!DOCTYPE html><html><body><p>Hi <b>x</p><!-- no --></body></html>"),
    (2, ""),
    (3, "just text, 2 < 3"),
    (4, "</div></div><ul><li>one</li><li><ul><li>two</ul></ul>tail"),
    (5, "<div><script>var a = '</p><div>';</script><style>p{}</style><br/></div>"),
    (6, "<div class='a'\n>" + "it's\n\"q\"\t\\ " * 9 + "</div"),
    (7, "<a><b><c>" * 3 + "x" + "</c></a>" * 2),
    (8, "<!-- open comment <p>text"),
    (9, "<script>never closed <i>x</i>"),
]


def nested(levels: int) -> str:
    return "<div>" * levels + "deep" + "</div>" * levels


def parents(depths: list[int]) -> list[list[int]]:
    """Ancestors of each node, root first."""
    stack: list[int] = []
    found = []
    for i, depth in enumerate(depths):
        del stack[depth:]
        found.append(list(stack))
        stack.append(i)
    return found


def outline(nodes, include=None, exclude=None) -> str:
    """Outline of (depth, type, text) nodes by recursion over the tree."""
    children: list[list[int]] = [[] for _ in nodes]
    roots = []
    for i, above in enumerate(parents([n[0] for n in nodes])):
        (children[above[-1]] if above else roots).append(i)
    lines: list[str] = []

    def show(i: int, level: int) -> None:
        _, kind, text = nodes[i]
        line = "  " * level + kind
        if not children[i]:
            shown = (text or "").replace("\n", "\\n")
            shown = shown[:47] + "..." if len(shown) > 50 else shown
            line += f": {shown!r}"
        lines.append(line)
        if include and kind not in include or not include and exclude and kind in exclude:
            return
        for child in children[i]:
            show(child, level + 1)

    for root in roots:
        show(root, 0)
    return "\n".join(lines)
