"""Literal rows of the registry tables."""


def place(objectid, name, typename, level, actual=1):
    return (objectid, f"guid-{objectid}", name, typename, str(level), actual, 1)


def house(objectid, housenum, addnum1=None, addnum2=None, housetype=2, actual=1):
    return (objectid, f"guid-{objectid}", housenum, addnum1, addnum2, housetype, actual)


def link(path, active=1):
    ids = [int(step) for step in path.split(".")]
    return (ids[-1], ids[-2] if len(ids) > 1 else None, path, active)
