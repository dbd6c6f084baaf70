"""Fixed values of the data model: types, relations, labels, aliases; and the schemas of files."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed values.
ENTITY_TYPES = ("protocol", "concept", "mechanism", "metric")
RELATION_TYPES = ("contains", "depends_on", "compared_with", "applied_to")
NODE_LABELS = {"protocol": "Protocol", "concept": "Concept", "mechanism": "Mechanism", "metric": "Metric"}
EDGE_LABELS = {"contains": "CONTAINS", "depends_on": "DEPENDS_ON", "compared_with": "COMPARED_WITH", "applied_to": "APPLIED_TO"}
#: Endings that add nothing to an entity's name, of which one is taken off.
SUFFIXES = ("协议", "算法", "机制", "方法", "技术", "方式")
#: Names and the abbreviation they are merged under.
ALIASES = {
    "传输控制协议": "TCP",
    "用户数据报协议": "UDP",
    "超文本传输协议": "HTTP",
    "超文本传送协议": "HTTP",
    "域名系统": "DNS",
    "文件传输协议": "FTP",
    "简单邮件传输协议": "SMTP",
    "简单邮件传送协议": "SMTP",
    "地址解析协议": "ARP",
    "逆地址解析协议": "RARP",
    "网际控制报文协议": "ICMP",
    "网际协议": "IP",
    "往返时延": "RTT",
    "往返时间": "RTT",
    "最大传输单元": "MTU",
    "最大报文段长度": "MSS",
    "服务质量": "QoS",
    "开放系统互连": "OSI",
    "网络地址转换": "NAT",
    "动态主机配置协议": "DHCP",
    "简单网络管理协议": "SNMP",
    "资源预留协议": "RSVP",
    "多协议标签交换": "MPLS",
    "边界网关协议": "BGP",
    "内部网关协议": "IGP",
    "开放最短路径优先": "OSPF",
    "路由信息协议": "RIP",
}

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
REVIEW = T.StructType([T.StructField(n, T.StringType()) for n in ("decision", "reason_code", "reason")])
RAW_ENTITY = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "type", "description")])
RAW_TRIPLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("head", "relation", "tail", "evidence")]
    + [T.StructField("evidence_span", SPAN), T.StructField("review", REVIEW)]
)
EXTRACTION = T.StructType(
    [
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("titles", T.ArrayType(T.StringType())),
        T.StructField("extractor_version", T.StringType()),
        T.StructField("entities", T.ArrayType(RAW_ENTITY)),
        T.StructField("triples", T.ArrayType(RAW_TRIPLE)),
    ]
)
CHUNK = T.StructType(
    [
        T.StructField("titles", T.ArrayType(T.StringType())),
        T.StructField("content", T.StringType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("source_file", T.StringType()),
    ]
)
GOLD_TRIPLE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("head", "head_type", "relation", "tail", "tail_type", "evidence", "source_file")]
    + [T.StructField("chunk_index", T.IntegerType()), T.StructField("frequency", T.LongType()), T.StructField("evidences", T.ArrayType(T.StringType()))]
)
GRAPH = T.StructType(
    [
        T.StructField("entities", T.ArrayType(T.StructType([*RAW_ENTITY.fields, T.StructField("frequency", T.LongType())]))),
        T.StructField("triples", T.ArrayType(GOLD_TRIPLE)),
    ]
)
