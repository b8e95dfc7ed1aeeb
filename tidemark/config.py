"""Where streams come from: a JDBC database or a lake of Parquet datasets."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from tidemark.functions.keys import uri

_URL_SECRETS = (
    re.compile(r"(?<=:)[^:/@\s]+/[^@\s]+(?=@)"),  # jdbc:oracle:thin:user/password@host
    re.compile(r"(?<=//)[^/@\s]+:[^@\s]+(?=@)"),  # //user:password@host
    re.compile(r"(?i)(?<=password=)[^;&\s]+"),
)


def _hide(text: str) -> str:
    for pattern in _URL_SECRETS:
        text = pattern.sub("***", text)
    return text


@dataclass(frozen=True)
class JdbcSource:
    """A database read over JDBC.

    ``schemas`` are owner names, matched exactly (databases such as Oracle keep
    unquoted names in upper case). ``dictionary`` picks the column dictionary
    that discovery reads: ``oracle`` or ``ansi`` (information_schema).
    ``fetchsize`` is rows per round trip; the Oracle driver's own default of 10
    makes a bulk read latency bound.
    """

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    schemas: tuple[str, ...] = ()
    dictionary: str = "oracle"
    fetchsize: int = 10_000
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __repr__(self) -> str:
        return f"JdbcSource(url={_hide(self.url)!r}, schemas={self.schemas!r})"

    def reader_options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetchsize),
        }
        return {k: v for k, v in given.items() if v is not None} | dict(self.options)

    def redact(self, text: str) -> str:
        if self.password:
            text = text.replace(self.password, "***")
        return _hide(text)

    @classmethod
    def oracle(
        cls,
        host: str,
        port: int | str,
        service_name: str,
        user: str,
        password: str,
        schemas: tuple[str, ...] = (),
        **more,
    ) -> JdbcSource:
        return cls(
            url=f"jdbc:oracle:thin:@//{host}:{int(port)}/{service_name}",
            user=user,
            password=password,
            driver="oracle.jdbc.OracleDriver",
            schemas=tuple(schemas),
            dictionary="oracle",
            **more,
        )

    @classmethod
    def oracle_from_env(cls, schemas: tuple[str, ...] = (), **more) -> JdbcSource:
        """An Oracle source from ORACLE_HOST, _PORT, _SERVICE_NAME, _USER, _PASSWORD."""
        names = ("HOST", "PORT", "SERVICE_NAME", "USER", "PASSWORD")
        missing = [f"ORACLE_{n}" for n in names if not os.environ.get(f"ORACLE_{n}")]
        if missing:
            raise KeyError(f"not set in the environment: {', '.join(missing)}")
        host, port, service, user, password = (os.environ[f"ORACLE_{n}"] for n in names)
        return cls.oracle(host, port, service, user, password, schemas, **more)


@dataclass(frozen=True)
class LakeSource:
    """Parquet datasets laid out as ``<root>/<schema>/<stream><suffix>``."""

    root: str
    schemas: tuple[str, ...] = ()
    suffix: str = ".parquet"

    def path(self, schema: str, stream: str) -> str:
        return uri(self.root, schema, stream + self.suffix)

    def redact(self, text: str) -> str:
        return text


# Spark's documented settings for the S3A committers.
_DIRECT_COMMIT = {
    "spark.hadoop.fs.s3a.committer.name": "magic",
    "spark.sql.sources.commitProtocolClass": (
        "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol"
    ),
    "spark.sql.parquet.output.committer.class": (
        "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter"
    ),
}


def store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    region: str = "us-east-1",
    path_style: bool = True,
    direct_commit: bool = False,
) -> dict[str, str]:
    """Session settings that let ``s3a://`` paths reach an S3-compatible store.

    Needs the hadoop-aws module on the cluster. An endpoint without a scheme is
    taken as plain http. By default a job's files are written aside and renamed at
    the end, which on an object store copies every byte again; ``direct_commit``
    completes uploads in place instead and needs the spark-hadoop-cloud module too.
    """
    if "://" not in endpoint:
        endpoint = f"http://{endpoint}"
    commit = _DIRECT_COMMIT if direct_commit else {}
    return commit | {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(
            endpoint.startswith("https")
        ).lower(),
    }


Source = JdbcSource | LakeSource
