"""A hand-made room log and what must come out of it."""

CLASSROOM, STUDENT = "classroom", "student"

LOG = [
    (0, CLASSROOM, "A", "1"),
    (1, STUDENT, "s1", "A"),
    (2, STUDENT, "s2", "A"),
    (3, STUDENT, "s1", "B"),
    (4, CLASSROOM, "B", "0"),
    (5, STUDENT, "s3", "A"),
    (6, CLASSROOM, "A", "5"),
    (7, STUDENT, "s2", "B"),
    (8, STUDENT, "s2", "B"),
    (9, STUDENT, "s3", "B"),
    (10, CLASSROOM, "A", " 7"),
    (11, STUDENT, "s4", None),
]
SCHEMA = "seq bigint, topic string, key string, value string"

CHANGELOG = {
    (1, 1, "A", 1), (2, 1, "A", 2), (3, 0, "A", 1), (3, 1, "B", 1), (5, 1, "A", 2), (7, 0, "A", 1),
    (7, 1, "B", 2), (8, 0, "B", 1), (8, 1, "B", 2), (9, 0, "A", 0), (9, 1, "B", 3),
}
CHANGES = {
    (1, 1, "A", 1, 1), (2, 1, "A", 2, 1), (3, 0, "A", 1, 1), (4, 0, "B", 1, 0), (5, 1, "A", 2, 1), (6, 0, "A", 2, 5),
    (7, 0, "A", 1, 5), (7, 1, "B", 2, 0), (8, 0, "B", 1, 0), (8, 1, "B", 2, 0), (9, 0, "A", 0, 5), (9, 1, "B", 3, 0),
}
LABELLED = {
    (2, 1, "A", "2"), (3, 0, "A", "OK"), (5, 1, "A", "2"), (6, 0, "A", "2"), (7, 0, "A", "1"),
    (7, 1, "B", "2"), (8, 0, "B", "1"), (8, 1, "B", "2"), (9, 0, "A", "0"), (9, 1, "B", "3"),
}
ALERTS = {
    (2, 1, "A", "2"), (3, 0, "A", "OK"), (4, 0, "B", "1"), (5, 1, "A", "2"), (6, 0, "A", "OK"),
    (7, 1, "B", "2"), (8, 0, "B", "1"), (8, 1, "B", "2"), (9, 1, "B", "3"),
}
OCCUPANCY = {("A", 0), ("B", 3)}
CAPACITY = {("A", 5), ("B", 0)}


def topics(log):
    """The log's two topics, batch or streaming."""
    return log.where(f"topic = '{STUDENT}'"), log.where(f"topic = '{CLASSROOM}'")


def rows(frame):
    found = [tuple(row) for row in frame.collect()]
    assert len(found) == len(set(found))
    return set(found)
