"""What the tests of this folder share. Not in conftest.py, as each folder has a module of that name."""

SF_DIR = "/root/testdata/sf0.001"


def rows(frame, *order):
    """Rows as plain tuples, in a fixed order."""
    found = [tuple(row) for row in frame.collect()]
    return found if order == (None,) else sorted(found, key=repr)
