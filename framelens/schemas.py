"""Schemas of the tables that sources read and operators exchange."""

from __future__ import annotations

BOX = "x1 double, y1 double, x2 double, y2 double"
DETECTIONS = f"image string, det long, cls int, conf double, {BOX}, track_id long"
COCO_IMAGES = "array<struct<id:bigint,width:int,height:int,file_name:string>>"
COCO_ANNOTATIONS = "array<struct<id:bigint,image_id:bigint,category_id:int,area:double,bbox:array<double>,iscrowd:int,segmentation:string>>"
COCO_CATEGORIES = "array<struct<id:int,name:string>>"
COCO = f"images {COCO_IMAGES}, annotations {COCO_ANNOTATIONS}, categories {COCO_CATEGORIES}"
MANIFEST = (
    "type string, task string, depth_scale double, class_names map<string,string>, kpt_shape array<int>, file string, url string, split string,"
    " annotations map<string,array<array<double>>>, depth struct<url:string,hash:string,shape:array<int>>"
)
TRIALS = "iteration long, fitness double, hyperparameters map<string,double>, datasets map<string,map<string,double>>"
TRACKS = f"stream long, frame long, idx long, track_id long, score double, cls string, {BOX}"
