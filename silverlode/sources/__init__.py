from silverlode.sources.files import read_raw
from silverlode.sources.layers import Layers
from silverlode.sources.streams import bus_stream, file_stream

__all__ = ["Layers", "bus_stream", "file_stream", "read_raw"]
