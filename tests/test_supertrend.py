"""The block description of a band against following it row by row."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.operators.supertrend import block_exits, leave_block

numbers = st.integers(-20, 20).map(float)


def follow(last, close, basic, value):
    crossed = -1
    for i, (before, now, top) in enumerate(zip(last, close, basic)):
        value = top if top < value or before > value else value
        crossed = i if now > value else crossed
    return value, crossed


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(numbers, numbers), min_size=1, max_size=40), numbers, st.lists(numbers, max_size=8))
def test_leaving_value_and_last_crossing(rows, before, entering):
    close, basic = (np.array(x) for x in zip(*rows))
    last = np.concatenate([[before], close[:-1]])
    exits = block_exits(last, close, basic)
    for value in [*entering, -np.inf, np.inf, *close, *basic]:
        assert leave_block(value, exits, close[-1], len(close)) == follow(last, close, basic, value)


def test_first_row_of_a_symbol_has_no_last_close():
    exits = block_exits(np.array([np.nan, 1.0]), np.array([1.0, 2.0]), np.array([5.0, 4.0]))
    assert leave_block(np.inf, exits, 2.0, 2) == (4.0, -1)
