"""What every command line does around its work."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import TypeVar

from verdance.session import get_session, remove_scratch, scratch_mark

Result = TypeVar("Result")


def job(run: Callable[..., Result]) -> Callable[..., Result]:
    """Removes the run's scratch folders when its results are written, or it has failed."""

    @wraps(run)
    def main(argv: list[str] | None = None) -> Result:
        mark = scratch_mark()
        try:
            return run(argv)
        finally:
            remove_scratch(get_session(), mark)

    return main
