"""Which checks of a fused pass spoil it: found by halving, so that the others cost few scans more."""

from __future__ import annotations

from collections.abc import Callable, Sequence

Slot = tuple[str, str]  # table, slot
Outcome = tuple[int | None, str | None]  # value, error
Run = Callable[[Sequence[Slot]], dict[Slot, Outcome]]


class Stopped(Exception):
    """The pass has been stopped from outside: no part of it is tried again."""


#: Checks found bad by halving; where there are more of them, those that are left run one by one.
HALVINGS = 2


def outcomes_of(slots: Sequence[Slot], run: Run, analyzed: Callable[[Sequence[Slot]], object], alone: Run | None = None) -> dict[Slot, Outcome]:
    """The outcome of every slot: values where they can be had, errors with their own messages for the rest.

    run: values of some slots in one pass, or an exception. analyzed: builds that pass and runs nothing; a slot that fails
    there is an error without a scan. alone: another plan for one slot, tried before its error counts.

    All slots run together. If that fails, the half that fails is halved until one slot is left, while slots of halves not
    tried are put off and then run together: one bad slot among n costs no more than log2(n) + 2 scans besides the first. After
    HALVINGS of them the remaining ones run one by one, so a table that cannot be read at all costs about one scan per slot.
    Where run raises Stopped, the slots without an outcome have its message.
    """
    found: dict[Slot, Outcome] = {}
    try:
        _settle_all(found, slots, run, analyzed, alone)
    except Stopped as e:
        found |= {slot: (None, str(e)) for slot in slots if slot not in found}
    return found


def _settle_all(found: dict[Slot, Outcome], slots: Sequence[Slot], run: Run, analyzed: Callable, alone: Run | None) -> None:
    def failure(some: Sequence[Slot]) -> str | None:
        """Runs some slots: None if their values are there, else the error."""
        try:
            found.update(run(some))
            return None
        except Stopped:
            raise
        except Exception as e:
            return str(e)

    def settle(slot: Slot, error: str | None = None) -> None:
        """The outcome of a slot by itself; error: what it gave alone, if it has run so."""
        error = error or failure([slot])
        if error and alone:
            try:
                found.update(alone([slot]))
                return
            except Stopped:
                raise
            except Exception as e:
                error = str(e)
        if error:
            found[slot] = (None, error)

    if not slots:
        return
    error = failure(slots)
    if error is None:
        return
    if len(slots) == 1:
        settle(slots[0], error)
        return
    left = []
    for slot in slots:
        try:
            analyzed([slot])
            left.append(slot)
        except Exception as e:
            found[slot] = (None, str(e))
    if len(left) < len(slots) and (not left or failure(left) is None):
        return
    for _ in range(HALVINGS):
        bad, put_off, error = left, [], None
        while len(bad) > 1:
            half, rest = bad[: len(bad) // 2], bad[len(bad) // 2 :]
            error = failure(half)
            if error:
                bad, put_off = half, rest + put_off
            else:
                bad, error = rest, None  # the culprit is here, as all together have failed
        settle(bad[0], error)
        left = put_off
        if not left or failure(left) is None:
            return
    for slot in left:
        settle(slot)
