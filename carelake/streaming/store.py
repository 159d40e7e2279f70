"""Record store: a base per bucket, append-only deltas, merge on read."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEQ, GONE = "_seq", "_gone"


class RecordStore:
    """Records by person in ``root/batch=<id>/bucket=<b>/`` folders and a
    manifest ``root/_manifest/<n>.json`` that names the live ones.

    A replace writes only the fresh records and a tombstone per person without
    one, under a folder of its own; no other person's record is read or
    written.  Every row carries the sequence of its batch.  A reader takes, per
    person, the row with the highest sequence: buckets without deltas are read
    as they are, the others leave out the persons that a delta holds.

    :meth:`compact` rewrites the buckets whose deltas hold more than a share of
    the base's rows, or are many, so the merge stays a small part of a read.

    The manifest is swapped by an atomic rename, and folders that none of the
    last ``keep_manifests`` names are deleted, so a reader always sees a
    complete state.  It has an entry per bucket and live delta of it, which
    compaction bounds by ``n_buckets * (max_deltas + 1)``.  One writer at a
    time (the single ``foreachBatch`` sink).  File operations go through the
    Hadoop FileSystem of the path."""

    #: batches remembered as applied; a stream re-runs its last one at most
    REMEMBERED = 100

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = 64, key: str = "origid",
                 keep_manifests: int = 3, max_ratio: float = 0.3, max_deltas: int = 16):
        self.spark, self.root, self.n_buckets, self.key = spark, root, n_buckets, key
        self.keep_manifests, self.max_ratio, self.max_deltas = keep_manifests, max_ratio, max_deltas
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(root).getFileSystem(conf)

    # ── manifest ──
    def _mdir(self):
        return self._Path(self.root + "/_manifest")

    def _manifests(self) -> list:
        if not self._fs.exists(self._mdir()):
            return []
        names = [x.getPath().getName() for x in self._fs.listStatus(self._mdir())]
        return sorted((n for n in names if n.endswith(".json")), key=lambda n: int(n.split(".")[0]))

    def _read_state(self, name: str) -> dict:
        stream = self._fs.open(self._Path(f"{self.root}/_manifest/{name}"))
        try:
            r = self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(stream))
            lines, line = [], r.readLine()
            while line is not None:
                lines.append(line)
                line = r.readLine()
        finally:
            stream.close()
        return json.loads("\n".join(lines))

    def state(self) -> dict:
        """``next`` sequence, ``applied`` batches, and per bucket the ``base``
        folder, its ``rows`` and the ``deltas`` [folder, rows], oldest first."""
        ms = self._manifests()
        return self._read_state(ms[-1]) if ms else {"next": 0, "applied": [], "buckets": {}}

    def manifest(self) -> dict[str, str]:
        """Bucket → the folders it is made of, as text."""
        return {b: "+".join(f for f in [e["base"], *[d[0] for d in e["deltas"]]] if f) for b, e in self.state()["buckets"].items()}

    def _write_state(self, state: dict) -> None:
        ms = self._manifests()
        seq = int(ms[-1].split(".")[0]) + 1 if ms else 0
        tmp = self._Path(f"{self.root}/_manifest/.{seq}.tmp")
        out = self._fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        if not self._fs.rename(tmp, self._Path(f"{self.root}/_manifest/{seq}.json")):
            raise IOError(f"manifest {seq} of {self.root} could not be put in place")
        self._prune()

    def _prune(self) -> None:
        ms = self._manifests()
        live = set()
        for m in ms[-self.keep_manifests:]:
            for e in self._read_state(m)["buckets"].values():
                live |= {e["base"], *[d[0] for d in e["deltas"]]}
        for m in ms[:-self.keep_manifests]:
            self._fs.delete(self._Path(f"{self.root}/_manifest/{m}"), False)
        for x in self._fs.listStatus(self._Path(self.root)):
            name = x.getPath().getName()
            if x.isDirectory() and name.startswith("batch=") and name.split("=", 1)[1] not in live:
                self._fs.delete(x.getPath(), True)

    # ── data ──
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.n_buckets)).cast("int")

    def _folder(self, batch: str) -> str:
        return f"{self.root}/batch={batch}"

    def _put(self, df: DataFrame, batch: str, mode: str = "overwrite") -> None:
        """Rows to the batch's folder by bucket; a bucket beyond the advisory
        size is written by several tasks (the rebalance splits it)."""
        df.withColumn("bucket", self.bucket()).hint("rebalance", F.col("bucket")).write.mode(mode).partitionBy("bucket").parquet(self._folder(batch))

    def _rows(self, batch: str) -> dict[str, int]:
        """Rows per bucket that a batch wrote; at most ``n_buckets`` numbers."""
        written = self.spark.read.parquet(self._folder(batch)) if self._wrote(batch) else None
        return {} if written is None else {str(r["bucket"]): r["count"] for r in written.groupBy("bucket").count().collect()}

    def _wrote(self, batch: str) -> bool:
        d = self._Path(self._folder(batch))
        return self._fs.exists(d) and any(x.getPath().getName().startswith("bucket=") for x in self._fs.listStatus(d))

    def _load(self, folders: list[tuple[str, str]]) -> DataFrame | None:
        paths = [f"{self._folder(batch)}/bucket={b}" for b, batch in folders]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, buckets=None) -> DataFrame | None:
        """The current records (of ``buckets``); None if there are none at all."""
        state = {b: e for b, e in self.state()["buckets"].items() if buckets is None or int(b) in buckets}
        quiet = self._load([(b, e["base"]) for b, e in state.items() if e["base"] and not e["deltas"]])
        base = self._load([(b, e["base"]) for b, e in state.items() if e["base"] and e["deltas"]])
        deltas = self._load([(b, d[0]) for b, e in state.items() for d in e["deltas"]])
        parts = [quiet]
        if deltas is not None:
            latest = deltas.groupBy(self.key).agg(F.max_by(F.struct(*deltas.columns), SEQ).alias("_r")).select("_r.*")
            parts.append(latest)
            if base is not None:
                parts.append(base.join(deltas.select(self.key).distinct(), self.key, "left_anti").select(base.columns))
        parts = [p for p in parts if p is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.where(~F.col(GONE)).drop(SEQ, GONE)

    def write(self, df: DataFrame, batch_id: str = "init") -> None:
        """Full (initial) load: the base of every bucket."""
        state = self.state()
        seq = state["next"]
        self._put(df.withColumn(SEQ, F.lit(seq).cast("bigint")).withColumn(GONE, F.lit(False)), str(batch_id))
        state["buckets"] = {b: {"base": str(batch_id), "rows": n, "deltas": []} for b, n in self._rows(str(batch_id)).items()}
        self._commit(state, str(batch_id))

    def _commit(self, state: dict, batch: str | None) -> None:
        state["next"] += 1
        if batch is not None:
            state["applied"] = (state["applied"] + [batch])[-self.REMEMBERED:]
        self._write_state(state)

    def replace(self, fresh: DataFrame, batch_id: str, persons: DataFrame | None = None) -> None:
        """Replace the records of ``persons`` (default: the persons in
        ``fresh``) by ``fresh`` (S9): a routed person without a fresh record —
        deleted at the source — gets a tombstone."""
        state, batch = self.state(), str(batch_id)
        seq = F.lit(state["next"]).cast("bigint")
        self._put(fresh.withColumn(SEQ, seq).withColumn(GONE, F.lit(False)), batch)
        if persons is not None:
            written = self.spark.read.parquet(self._folder(batch)).select(self.key) if self._wrote(batch) else fresh.select(self.key).limit(0)
            gone = persons.select(self.key).distinct().join(written, self.key, "left_anti")
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in fresh.schema.fields if f.name != self.key]
            marks = gone.select(self.key, *empty).select(*fresh.columns).withColumn(SEQ, seq).withColumn(GONE, F.lit(True))
            self._put(marks, batch, "append")
        for b, n in self._rows(batch).items():
            entry = state["buckets"].setdefault(b, {"base": None, "rows": 0, "deltas": []})
            entry["deltas"].append([batch, n])
        self._commit(state, batch)

    def due(self, ratio: float | None = None) -> list[str]:
        """Buckets whose deltas hold more than ``ratio`` of the base's rows or
        are more than ``max_deltas``."""
        ratio = self.max_ratio if ratio is None else ratio
        return [b for b, e in self.state()["buckets"].items()
                if e["deltas"] and (sum(d[1] for d in e["deltas"]) > ratio * e["rows"] or len(e["deltas"]) > self.max_deltas)]

    def compact(self, ratio: float | None = None) -> list[str]:
        """Rewrite the buckets that are due as new bases; returns them.  The
        records stay the same."""
        buckets = self.due(ratio)
        if not buckets:
            return []
        state = self.state()
        batch = f"base-{state['next']}"
        seq = F.lit(state["next"]).cast("bigint")
        self._put(self.read({int(b) for b in buckets}).withColumn(SEQ, seq).withColumn(GONE, F.lit(False)), batch)
        rows = self._rows(batch)
        for b in buckets:
            if b in rows:
                state["buckets"][b] = {"base": batch, "rows": rows[b], "deltas": []}
            else:                      # nobody left in it
                del state["buckets"][b]
        self._commit(state, None)
        return buckets

    def applied(self, batch_id) -> bool:
        """Whether this batch is committed (a re-run of it is skipped; its
        folder is never written again)."""
        return str(batch_id) in self.state()["applied"]
