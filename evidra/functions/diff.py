"""Strict unified diffs and conservative Python symbols: the parsers that expressions cannot hold."""

from __future__ import annotations

import ast
import re
from dataclasses import dataclass, field

HUNK = re.compile(r"^@@ -(\d+)(?:,(\d+))? \+(\d+)(?:,(\d+))? @@")
#: Line starts of a diff's head, and the messages of a diff that doesn't apply.
HEAD = ("--- ", "+++ ", "diff ", "index ")
E_HEAD, E_RANGE, E_NEW, E_BODY, E_CONTEXT, E_COUNT, E_NONE = (
    "Unsupported diff header", "Overlapping or out-of-range hunk", "New hunk offset mismatch", "Unsupported diff body", "Patch context mismatch", "Hunk count mismatch", "No hunks")


class DiffError(ValueError):
    pass


@dataclass
class Hunk:
    old_at: int
    old_n: int
    new_at: int
    new_n: int
    lines: list[tuple[str, str]] = field(default_factory=list)

    def side(self, signs: str) -> list[str]:
        return [body for sign, body in self.lines if sign in signs]


def hunks(diff: str):
    """The hunks in order, lazily: a fault in a later hunk is met only after the ones before it were taken."""
    now: Hunk | None = None
    for line in diff.splitlines(keepends=True):
        if line.startswith("\\ No newline at end of file") and now and now.lines:
            sign, body = now.lines[-1]
            now.lines[-1] = (sign, body.rstrip("\r\n"))
        elif now and not line.startswith("@@"):
            if line[0] not in " +-":
                raise DiffError(E_BODY)
            now.lines.append((line[0], line[1:]))
        elif m := HUNK.match(line):
            if now:
                yield now
            a, n, b, k = m.groups()
            n, k = int(n or 1), int(k or 1)
            now = Hunk(int(a) - (n > 0), n, int(b) - (k > 0), k)
        elif not line.startswith(HEAD):
            raise DiffError(E_HEAD)
    if now:
        yield now


def apply_diff(before: str, diff: str) -> str:
    """The text after the diff, which must fit line by line; DiffError otherwise."""
    source, made, at, n = before.splitlines(keepends=True), [], 0, 0
    for h in hunks(diff):
        n += 1
        if not at <= h.old_at <= len(source):
            raise DiffError(E_RANGE)
        made += source[at : h.old_at]
        if len(made) != h.new_at:
            raise DiffError(E_NEW)
        old, new = h.side(" -"), h.side(" +")
        if source[h.old_at : h.old_at + len(old)] != old:
            raise DiffError(E_CONTEXT)
        if (len(old), len(new)) != (h.old_n, h.new_n):
            raise DiffError(E_COUNT)
        made += new
        at = h.old_at + len(old)
    if not n:
        raise DiffError(E_NONE)
    return "".join(made + source[at:])


def make_diff(before: str, after: str, path: str = "file") -> str:
    """A unified diff that apply_diff takes back."""
    from difflib import unified_diff

    out = []
    for line in unified_diff(before.splitlines(keepends=True), after.splitlines(keepends=True), f"a/{path}", f"b/{path}"):
        out.append(line if line.endswith("\n") else line + "\n\\ No newline at end of file\n")
    return "".join(out)


def _walk(node: ast.AST, scope: tuple[str, ...], out: dict) -> None:
    for child in ast.iter_child_nodes(node):
        inner = scope
        if isinstance(child, (ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)):
            inner = (*scope, child.name)
            out["symbols"].append({"name": ".".join(inner), "kind": "class" if isinstance(child, ast.ClassDef) else "function", "line": child.lineno, "end_line": child.end_lineno})
        elif isinstance(child, ast.ImportFrom):
            out["imports"].update({a.asname or a.name: {"module": child.module or "", "level": child.level, "name": a.name} for a in child.names})
        elif isinstance(child, ast.Call):
            out["references"].append({"from": ".".join(scope) or "<module>", "expression": ast.unparse(child.func), "line": child.lineno, "simple_name": child.func.id if isinstance(child.func, ast.Name) else None})
        _walk(child, inner, out)


def inspect_code(path: str, content: str) -> dict:
    """status, symbols, references and relative-import aliases of a Python file; other files are not read."""
    out: dict = {"status": "parsed", "symbols": [], "references": [], "imports": {}}
    if not path.endswith(".py"):
        return out | {"status": "unsupported_language"}
    try:
        tree = ast.parse(content)
    except (SyntaxError, ValueError):
        return out | {"status": "parse_error"}
    _walk(tree, (), out)
    return out
