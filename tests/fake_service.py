"""A stand-in for a key/value service, for lookup tests (module-level so it pickles)."""

CALLS = []


class FakeClient:
    DATA = {"k1": "v1", "jack": "J"}

    def get(self, key):
        return self.DATA.get(key)


def make_client():
    return FakeClient()
