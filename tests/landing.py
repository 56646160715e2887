"""Writes catalog and license-list documents as a landing job would."""

import json

from tidemark.sources.catalog import read_documents

BASE = "https://catalog.example/v3"


def at(minute, digits=""):
    return f"2024-05-01T10:{minute:02d}:00{digits}Z"


def ref(kind, package, version, commit, url=None):
    return {
        "@id": url or f"{BASE}/leaf/{package}/{version}/{commit}",
        "@type": f"nuget:{kind}",
        "commitTimeStamp": commit,
        "nuget:id": package,
        "nuget:version": version,
    }


def details(package, version, commit, **kw):
    return ref("PackageDetails", package, version, commit, **kw)


def delete(package, version, commit):
    return ref("PackageDelete", package, version, commit)


def leaf_of(event, **fields):
    body = {
        "@id": event["@id"],
        "id": event["nuget:id"],
        "version": event["nuget:version"],
        "published": "2024-04-01T00:00:00Z",
    }
    body.update(fields)
    return body


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.index = {"commitTimeStamp": "", "items": []}
        for part in ("index", "pages", "leaves"):
            (root / part).mkdir(parents=True)
        self._n = 0
        self._save_index()

    def _save_index(self):
        (self.root / "index" / "index.json").write_text(json.dumps(self.index, indent=1))

    def page(self, events, name=None, commit=None, leaves=None):
        """Lands a page; every details event gets a plain leaf unless told otherwise."""
        self._n += 1
        url = f"{BASE}/page{name or self._n}.json"
        commit = commit or max(e["commitTimeStamp"] for e in events)
        self.index["items"] = [p for p in self.index["items"] if p["@id"] != url]
        self.index["items"].append({"@id": url, "commitTimeStamp": commit, "count": len(events)})
        self.index["commitTimeStamp"] = commit
        self._save_index()
        page = {"@id": url, "commitTimeStamp": commit, "items": events}
        (self.root / "pages" / f"{name or self._n}.json").write_text(json.dumps(page, indent=1))
        if leaves is None:
            leaves = [leaf_of(e) for e in events if e["@type"] != "nuget:PackageDelete"]
        self.leaves(leaves)
        return url

    def leaves(self, bodies):
        for body in bodies:
            self._n += 1
            text = body if isinstance(body, str) else json.dumps(body)
            (self.root / "leaves" / f"{self._n}.json").write_text(text)

    def read(self, part):
        return read_documents(self.spark, str(self.root / part))

    def sources(self):
        return (
            self.read("index"),
            lambda pages: self.read("pages"),
            lambda refs: self.read("leaves"),
        )


def license_list(spark, root, version, licenses, released="2024-02-08"):
    root.mkdir(parents=True, exist_ok=True)
    path = root / f"{version}.json"
    path.write_text(
        json.dumps(
            {"licenseListVersion": version, "releaseDate": released, "licenses": licenses}
        )
    )
    return read_documents(spark, str(path))
