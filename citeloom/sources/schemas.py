"""Declared schemas of the nested inputs, as DDL text. Nothing is inferred from the data."""

_TYPED_ID = "array<struct<type:string,value:string>>"

PUBLICATION = (
    "lens_id string, year_published int, date_published date, is_open_access boolean, is_retracted boolean,"
    " publication_type string, author_count int, scholarly_citations_count bigint,"
    " references_resolved_count bigint, references_count bigint, patent_citations_count bigint,"
    f" external_ids {_TYPED_ID},"
    f" source struct<title:string,publisher:string,type:string,country:string,issn:{_TYPED_ID}>,"
    " fields_of_study array<string>,"
    " mesh_terms array<struct<mesh_heading:string,mesh_id:string,qualifier_name:string,qualifier_id:string>>,"
    f" authors array<struct<first_name:string,last_name:string,ids:{_TYPED_ID},"
    f"affiliations:array<struct<name:string,name_original:string,country_code:string,grid_id:string,ids:{_TYPED_ID}>>>>,"
    " funding array<struct<org:string,funding_id:string,country:string>>,"
    " score double"
)

CONCEPT = (
    "display_name string, level int, works_count bigint, cited_by_count bigint,"
    " ancestors array<struct<id:string,level:int,display_name:string>>,"
    " related_concepts array<struct<id:string,level:int,display_name:string>>,"
    " ids struct<openalex:string,wikidata:string,wikipedia:string>"
)

_UPPER = "struct<id:string,display_name:string,wikidata:string,wikipedia:string>"
TOPIC = (
    "display_name string, description string, keywords array<string>,"
    " siblings array<struct<id:string,display_name:string>>, works_count bigint, cited_by_count bigint,"
    f" ids struct<openalex:string,wikipedia:string>, subfield {_UPPER}, field {_UPPER}, domain {_UPPER}"
)

ORGANISATION = (
    "id string, established int, status string, types array<string>, domains array<string>,"
    " locations array<struct<geonames_id:bigint,geonames_details:"
    "struct<name:string,country_code:string,country_name:string,lat:double,lng:double>>>,"
    " external_ids array<struct<type:string,preferred:string,all:array<string>>>,"
    " names array<struct<value:string,types:array<string>,lang:string>>,"
    " links array<struct<type:string,value:string>>,"
    " relationships array<struct<type:string,label:string,id:string>>,"
    " admin struct<created:struct<date:string,schema_version:string>,"
    "last_modified:struct<date:string,schema_version:string>>"
)

COUNTRY_FEATURES = (
    "type string, features array<struct<type:string,"
    "properties:struct<ISO_A2:string,ADMIN:string>,geometry:string>>"
)
