"""The queries of this folder, registered by name, with check SQL where SQL has a form."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
