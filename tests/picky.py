"""A store for the tests, which the workers import by name."""

from reshelve.sinks.collection import FileStore, Refused, Session


class Picky(FileStore):
    """Refuses any batch with customer 3."""

    def session(self, name):
        return PickySession(self, name)


class PickySession(Session):
    def insert(self, batch, documents):
        if any(key == 3 for key, _ in documents):
            raise Refused("not this one")
        super().insert(batch, documents)
