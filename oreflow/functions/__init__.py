from oreflow.functions.clock import moment
from oreflow.functions.params import bind, render, resolve
from oreflow.functions.rows import comparable, row_hash
from oreflow.functions.text import detail_lines, escape_html, thousands

__all__ = [
    "bind", "comparable", "detail_lines", "escape_html", "moment", "render", "resolve",
    "row_hash", "thousands",
]
