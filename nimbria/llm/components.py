"""Connected components, as the library's other operators use them."""

from __future__ import annotations

from nimbria.operators.components import components

__all__ = ["components"]
