"""Lines of a sensor log, for the tests."""


def log_line(engine, cycle, first, step=1.0):
    """A line whose sensor i reads ``first + (i - 1) * step``."""
    return " ".join(
        map(str, [engine, cycle, 0, 0, 0, *[float(first + i * step) for i in range(21)]])
    )
