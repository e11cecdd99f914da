"""Record layouts."""

COLUMN_VALUE = "struct<value:string,type:string,quoted:boolean>"
COLUMNS = f"map<string,{COLUMN_VALUE}>"
#: ingest_seq is the total order of arrival on a slot; wal_start alone is not unique.
WAL_RAW = "ingest_seq bigint, slot string, wal_start bigint, server_wal_end bigint, server_time_ms bigint, wal_data string"
SIDE = "struct<q:string,t:string,v:string>"
PAIRS = f"map<string,struct<new:{SIDE},old:{SIDE}>>"
STATS = "component string, stat_type string, stat_name string, unit string, value bigint, timestamp_ns bigint"
