"""`text_pieces`: a sink that writes pieces of text one behind the other, a file for each task.

Spark's own text sink ends every row with a separator, so a line would have to be one row. A task
holds one batch at a time. Files lie below `_temporary` until the job commits.
"""

import sys
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from fragloom.sources import fragment_source
from fragloom.sources.fragment_source import Written, open_system

# The sink travels to the workers, executors need no copy of this package.
cloudpickle.register_pickle_by_value(fragment_source)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class PieceSink(DataSource):
    @classmethod
    def name(cls):
        return "text_pieces"

    def schema(self):
        return "text string"

    def writer(self, schema, overwrite):
        return PieceWriter(self.options["path"], overwrite)


class PieceWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator):
        system, folder = open_system(self.path)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.txt"
        file = None
        for batch in iterator:
            if file is None and batch.num_rows:
                system.create_dir(f"{folder}/_temporary", recursive=True)
                file = system.open_output_stream(f"{folder}/_temporary/{name}", compression=None)
            for text in batch.column(0).cast(pa.large_binary()):
                file.write(text.as_buffer())
        if file is None:
            return Written([])
        file.close()
        return Written([(f"{folder}/_temporary/{name}", f"{folder}/{name}")])

    def commit(self, messages):
        system, folder = open_system(self.path)
        system.create_dir(folder, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(folder)):
                if info.is_file:
                    system.delete_file(info.path)
        for message in messages:
            for old, new in message.files if message else ():
                system.move(old, new)

    def abort(self, messages):
        system, _ = open_system(self.path)
        for message in messages:
            for old, _ in message.files if message else ():
                system.delete_file(old)
