"""Declared schemas of the JSON messages the engine reads (no inference on the hot path)."""

HIT_FIELDS = ("malname STRING, virus_type STRING, virus_family STRING, virus_platform STRING, "
              "virus_behaviors STRING, author STRING, rid STRING")
ENDPOINT = ("STRUCT<ip: STRING, port: STRING, mac: STRING, country: STRING, city: STRING, region: STRING, "
            "unit: STRING, isp: STRING, location: STRUCT<lon: STRING, lat: STRING>>")
BODY = "STRUCT<bytes: STRING, direction: STRING, fn: STRING, ft: STRING, md5: STRING>"
KV_LIST = "ARRAY<STRUCT<key: STRING, value: STRING>>"

SENSOR_EVENT = f"""
  id STRING, dev STRING, type STRING, is_malicious BOOLEAN, alert BOOLEAN, label STRING,
  ts STRUCT<start: STRING>, proto ARRAY<STRING>, malname ARRAY<STRING>,
  src {ENDPOINT}, dst {ENDPOINT},
  s2c STRUCT<pkts: BIGINT, bytes: BIGINT>,
  url ARRAY<STRING>, domain ARRAY<STRING>,
  file ARRAY<STRUCT<md5: STRING, name: STRING, bytes: STRING, type: STRING, direction: STRING>>,
  avlist ARRAY<STRUCT<victim: STRUCT<name: STRING>>>,
  d STRUCT<
    url: ARRAY<STRUCT<{HIT_FIELDS}>>,
    domain: ARRAY<STRUCT<{HIT_FIELDS}>>,
    ip: ARRAY<STRUCT<{HIT_FIELDS}>>,
    file: ARRAY<STRUCT<{HIT_FIELDS}, md5 STRING>>,
    sengine: ARRAY<STRUCT<{HIT_FIELDS}, msg STRING, classtype STRING,
                          related STRUCT<attacker: ARRAY<STRING>>,
                          nsacss ARRAY<STRUCT<stage: STRING, objective: STRING, action: STRING>>,
                          attck ARRAY<STRUCT<tactic: STRING, techniques: STRING>>,
                          reference ARRAY<STRING>>>>,
  dns STRUCT<msg: STRUCT<msg_type: STRING,
             record: ARRAY<STRUCT<Rtype: STRING, class: STRING, cname: STRING, data: STRING>>>>,
  email STRUCT<msg: STRUCT<from: STRING, to: ARRAY<STRING>, sender: STRING, sub: STRING, content: STRING,
               attach: ARRAY<STRUCT<md5: STRING, fn: STRING, ft: STRING>>>>,
  ftp STRUCT<download: {BODY}, upload: {BODY}>,
  http STRUCT<request: STRUCT<method: STRING,
                              header: STRUCT<host: STRING, uri: STRING, other: {KV_LIST}>,
                              body: {BODY}>,
              response: STRUCT<header: STRUCT<other: {KV_LIST}>, body: {BODY}>>,
  msg STRUCT<upload: {BODY}, download: {BODY}>
"""

SENSOR_BATCH = f"data ARRAY<STRUCT<{SENSOR_EVENT.replace(chr(10), ' ')}>>"

# Endpoint agent message (short-key dictionary, SURVEY §1.4).  Digit keys are legal
# field names and are addressed with back-ticks: ``col("data.i.`1`")``.
ENDPOINT_EVENT = """
  type STRING, ts STRING,
  client STRUCT<uuid: STRING, ip: STRING, server_uid: STRING, server_ip: STRING, name: STRING,
                group_id: STRING, company_id: STRING>,
  data STRUCT<
    a: STRING, b: STRING,
    c: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING>,
    d: STRUCT<`1`: ARRAY<STRUCT<`1`: STRING, `2`: STRING>>>,
    e: ARRAY<STRUCT<`1`: STRING, `2`: STRUCT<`1`: STRING>, `3`: ARRAY<STRUCT<`1`: STRING>>, p: STRING>>,
    f: STRUCT<`1`: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING>, `2`: STRUCT<`1`: STRING>,
              `3`: STRING, `4`: STRING, `5`: STRING, `7`: STRING>,
    g: ARRAY<STRUCT<`3`: ARRAY<STRUCT<`1`: STRING>>, p: STRING>>,
    h: STRUCT<`1`: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING>,
              `2`: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING>, `3`: STRING, `4`: STRING>,
    i: STRUCT<
      `1`: ARRAY<STRUCT<`1`: STRING, `2`: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING>, `3`: STRING, `4`: STRING,
                        `5`: STRING, `6`: STRING, `7`: STRING, `8`: STRING, `9`: STRING, a: STRING, b: STRING, c: STRING, e: STRING,
                        g: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING>>,
                        h: STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING, `5`: STRING, `6`: STRING>,
                        i: STRUCT<`7`: STRING, `8`: STRING>, j: STRING, k: STRING, l: STRING>>,
      `2`: ARRAY<STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING, `5`: STRING, `6`: ARRAY<STRING>, `7`: STRING,
                        `8`: ARRAY<STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRING, `5`: ARRAY<STRING>,
                                          `6`: ARRAY<STRING>, `7`: STRING, `8`: STRING, `9`: STRING, a: STRING>>>>,
      `3`: ARRAY<STRUCT<`1`: STRING, `2`: STRING, `3`: STRING, `4`: STRUCT<`1`: STRING, `2`: STRING>,
                        `5`: STRUCT<`1`: STRING>, `6`: STRING>>>>,
  fileinfo ARRAY<STRUCT<md5: STRING, path: STRING, size: STRING, malname: STRING, mt: STRING, ct: STRING,
                        ver: STRING, digsig: STRING, option: STRING>>,
  parent_process_id STRING, parent_process_path STRING, parent_process_md5 STRING,
  child_process_path STRING, child_process_md5 STRING, parameters STRING,
  registry_path STRING, registry_key STRING, registry_value STRING, malname STRING
"""
